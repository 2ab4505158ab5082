"""Importance resampling and the audit of filters against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

from tests.llm import brute
from tests.llm.test_operators import ODD
from voxatlas.llm import audit, importance


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(200)] + ["The", "ÉTÉ", "été", "a|b", "$5", "UP"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 120))) for _ in range(120)]
    texts += [texts[3]] * 10 + ["Same words " * 40] * 5 + [" ".join(rng.choice(vocabulary) for _ in range(20_000))] + ODD
    rng.shuffle(texts)
    return list(enumerate(texts))


def clashing(spark, rows, schema, names):
    df = spark.createDataFrame(rows, schema).repartition(3)
    return df.selectExpr("*", *(f"'clash' as {n}" for n in names))


def plain_resample(docs, target, longest, buckets, least, percent):
    def features(text):
        ws = brute.ALNUM.findall((text or "").translate(brute.LOWER))
        return len(ws), [" ".join(ws[i : i + n]) for n in range(1, longest + 1) for i in range(len(ws) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    raw, goal = Counter(), Counter()
    for _, t in docs:
        raw.update(map(bucket, features(t)[1]))
    for t in target:
        goal.update(map(bucket, features(t)[1]))
    s_all, t_all = sum(raw.values()), sum(goal.values())
    gain = [math.floor(1000 * math.log((goal[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for i, t in docs:
        n, fs = features(t)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in fs)
        rows.append([i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    drawn = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], -1 if r[0] is None else r[0], -r[2]))
    for k, r in enumerate(drawn[: percent * len(drawn) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=str)


def got_resample(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str)


def test_resample(spark):
    docs, target = corpus(), ["w1 w2 w3 The w5", None, "été w7 " * 30]
    names = ("weight", "score", "rank", "buckets", "_words", "_place", "n_features")
    table = clashing(spark, docs, "doc_id bigint, text string", names)
    goal = clashing(spark, [(k, t) for k, t in enumerate(target)], "item_id bigint, text string", names)
    for longest, buckets, percent in ((1, 10_000, 10), (2, 64, 50), (3, 1, 100)):
        got = importance.resample(table, goal, longest=longest, buckets=buckets, percent=percent)
        assert got_resample(got) == plain_resample(docs, target, longest, buckets, 20, percent)
    kept = importance.drawn(table, goal)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in plain_resample(docs, target, 1, 10_000, 20, 10) if r[5]}


def test_resample_of_odd_tables(spark):
    """Repeated rows and ids, null ids, no target, no rows, no words."""
    text = " ".join(f"v{k}" for k in range(30))
    docs = [(1, text), (1, text), (1, text + " more"), (None, text), (None, None), (2, ""), *[(k, text) for k in range(10, 400)]]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert got_resample(importance.resample(table, none, percent=37)) == plain_resample(docs, [], 1, 10_000, 20, 37)
    assert importance.resample(table.limit(0), none).count() == 0
    assert [r["rank"] for r in importance.resample(table.where("doc_id = 2"), none).collect()] == [None]


WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_audit(docs, labels):
    """Every order applied to every document, one filter after the other."""
    docs = [(i, s or "", t or "") for i, s, t in docs]
    first = {}
    for i, _, t in docs:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    out = Counter()
    for i, s, t in docs:
        ws = WORD.findall(t)
        fails = set()
        if len(ws) < 50:
            fails.add("A")
        if 100 * len(set(ws)) < 65 * len(ws):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            fails.add("C")
        if re.search("[#$%&*|]", t):
            fails.add("D")
        if i is not None and i > first[t]:
            fails.add("E")
        good, toxic = (any(x == i and i is not None and v[k] == 1 for x, *v in labels) for k in (0, 1))
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                bad = f in fails
                key = (s, order, step)
                out[(*key, "redundant")] += bad and gone
                out[(*key, "removed")] += bad and not gone
                out[(*key, "good_lost")] += bad and not gone and good
                out[(*key, "toxic_lost")] += bad and not gone and toxic
                out[(s, f, "shapley")] += bad and not gone
                out[(*key, "unique_fails")] += fails == {f}
                gone |= bad
                out[(*key, "kept")] += not gone
    rows = []
    for s in {s for _, s, _ in docs}:
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                rows.append((s, order, step, *(out[(s, order, step, c)] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")), out[(s, f, "shapley")]))
    return sorted(rows)


def got_audit(df):
    assert df.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sorted(tuple(r) for r in df.collect())


def test_audit(spark):
    rng = random.Random(4)
    docs = [(i, rng.choice(["a", "b", "b", "b", None, ""]), t) for i, t in corpus()]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, len(docs), 2)] + [(2, 1, 0), (None, 1, 1), (10**6, 1, 1)]
    names = ("row", "word", "n", "h1", "h2", "part", "fails", "good", "toxic", "step", "p", "b", "first_id")
    table = clashing(spark, docs, "doc_id bigint, source string, text string", names)
    marks = clashing(spark, labels, "doc_id bigint, quality int, toxic int", ("text", "part", "good", "n"))
    assert got_audit(audit.audit(table, marks)) == plain_audit(docs, labels)


def test_audit_of_odd_tables(spark):
    """Repeated rows, one id with two texts, null ids, copies in hundreds, no labels, no rows."""
    docs = [(1, "a", "x y"), (1, "a", "x y"), (1, "a", "z"), (None, "a", "x y"), (None, None, None), (3, "", ""), *[(k, "c", "copy " * 60) for k in range(300)]]
    table = spark.createDataFrame(docs, "doc_id bigint, source string, text string").repartition(4)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert got_audit(audit.audit(table, labels)) == plain_audit(docs, [])
    assert audit.audit(table.limit(0), labels).count() == 0
