"""The pipeline against plain versions of its stages."""

import zlib

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_operators import encoded
from voxatlas.llm import quality


def test_pipeline(spark, sf):
    table = {name: spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels", "benchmark")}
    docs = {r["doc_id"]: r["text"] for r in table["documents"].collect()}
    model = quality.train(table["documents"], table["labels"])
    docs = {r["doc_id"]: docs[r["doc_id"]] for r in quality.score(table["documents"], model).where("predicted = 1").collect()}
    docs = {i: text for i, text, n, gone in brute.lines(docs.items()) if not gone or gone < n}
    docs = {i: docs[i] for i, _, component in brute.components(docs.items(), 5, 80) if component == i}
    items = [(r["item_id"], r["text"]) for r in table["benchmark"].collect()]
    docs = {i: docs[i] for i, *_, contaminated in brute.passages(docs.items(), items) if not contaminated}
    want = dict(zip(docs, encoded(docs.values()), strict=True))
    got = corpus_pipeline.run(spark, sf).toPandas()
    assert set(got["doc_id"]) == set(want)
    for i, own in got.sort_values("start").groupby("doc_id"):
        assert own["length"].sum() == len(want[i]) == own["doc_tokens"].iloc[0]
        for s, n, crc in zip(own["start"], own["length"], own["ids_crc32"], strict=True):
            assert zlib.crc32(want[i][s : s + n].tobytes()) == crc


def test_stages_keep_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns, name
        assert out.where("n_chars <> length(text)").isEmpty() or name == "quality_classifier"
        docs = spark.createDataFrame(out.collect(), out.schema)


def odd_documents(spark, sf):
    """Repeated rows, one id with several texts, nulls, empty texts, and columns of names that operators use."""
    given = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    near = " ".join(f"n{k}" for k in range(100))
    rows = given + given[:5] + [(i + 1000, t) for i, t in given[:5]]
    rows += [(None, None), (None, near), (7000, None), (7000, None), (7001, ""), (7002, " \n "), (7010, near), (7011, near + " more"), (7011, "a text that no other row of the table has, with an id that is there twice"), (None, "nor has any other row this one")]
    names = ("n_lines", "n_removed", "row", "node", "_all", "rest", "component_id", "_maybe", "score", "copy", "length")
    docs = spark.createDataFrame([(*r, "en", "s", None if r[1] is None else len(r[1])) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return docs.selectExpr("*", *(f"'clash' as {n}" for n in names)).repartition(3)


def plain(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_stages_on_odd_tables(spark, sf):
    docs = odd_documents(spark, sf)
    given = plain(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.dtypes == docs.dtypes, name
        assert out.where(" or ".join(f"{c} <> 'clash'" for c in docs.columns[5:])).isEmpty(), name
        if name != "line_dedup":
            got = plain(out)
            assert all(got.count(r) in (0, given.count(r)) for r in set(given)) and set(got) <= set(given), name
        assert stage(spark, docs.limit(0), sf).isEmpty(), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).select("doc_id", "ids_crc32").count() >= len(given)


def test_near_copies_of_odd_rows(spark, sf):
    """What stays is one text of each group, and no text is lost that nothing else has."""
    got = plain(corpus_pipeline.jaccard_join(spark, odd_documents(spark, sf), sf))
    near = " ".join(f"n{k}" for k in range(100))
    kept = [r for r in got if r[1] in (near, near + " more")]
    assert kept == [(7010, near)]
    assert (7011, "a text that no other row of the table has, with an id that is there twice") in got
    assert (None, "nor has any other row this one") in got and got.count((7000, None)) == 2
    two = spark.createDataFrame([(1, "B " + near), (5, "A " * 9 + "end"), (5, "B " + near)], "doc_id bigint, text string")
    assert plain(corpus_pipeline.jaccard_join(spark, two, sf)) == [(1, "B " + near), (5, "A " * 9 + "end")]


def test_lines_of_odd_rows(spark, sf):
    docs = spark.createDataFrame([(1, "one line of some words\nanother line", 3), (2, "one line of some words\nits own line", 3), (3, "another line", 3), (None, "another line", 3), (4, None, 3)], "doc_id bigint, text string, n_lines int").selectExpr("*", "length(text) as n_chars")
    got = sorted(map(tuple, corpus_pipeline.line_dedup(spark, docs, sf).collect()), key=str)
    assert got == [(1, "one line of some words\nanother line", 3, 35), (2, "its own line", 3, 12), (4, None, 3, None), (None, "another line", 3, 12)]


def test_results_written_in_either_order(spark, sf):
    """A stage's result needs no table that calling another one takes away."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for first, second in ((corpus_pipeline.line_dedup, corpus_pipeline.jaccard_join), (corpus_pipeline.jaccard_join, corpus_pipeline.line_dedup)):
        a, b = first(spark, docs, sf), second(spark, docs, sf)
        assert b.count() > 0 and a.count() > 0
