"""Plain versions of the operators, on small tables."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

PLAIN = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def substrings(docs, k=50):
    seen, out = {}, []
    for i, text in sorted(docs, key=lambda d: d[0]):
        words = PLAIN.findall(text or "")
        gone, new = [False] * len(words), []
        for j in range(len(words) - k + 1):
            window = tuple(words[j : j + k])
            if seen.get(window, i) < i:
                gone[j : j + k] = [True] * k
            else:
                new.append(window)
        for window in new:
            seen.setdefault(window, i)
        out.append((i, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g))))
    return sorted(out)


def shingles(text, size):
    words = PLAIN.findall((text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[j : j + size]) for j in range(len(words) - size + 1))


def components(docs, size, percent):
    sets = {i: shingles(t, size) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets.items())


def rules(text):
    words = PLAIN.findall(text or "")
    windows = Counter(tuple(words[j : j + 3]) for j in range(len(words) - 2))
    marked = [False] * len(words)
    for j in range(len(words) - 2):
        if windows[tuple(words[j : j + 3])] > 1:
            marked[j : j + 3] = [True] * 3
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if PLAIN.search(line):
            dup += line in seen
            seen.add(line)
    n, r = len(words), sum(marked)
    return n, sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), dup, r, n < 50 or 100 * r > 50 * n


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    kinds = [k for _, k, _ in found]
    return (*(kinds.count(k) for k in range(3)), sha(",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))))


def passages(docs, items, window=13):
    windows = defaultdict(set)
    for i, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        size = min(window, len(words))
        for j in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[j : j + size])].add(str(i))
    out = []
    for i, text in docs:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, found = [False] * len(words), set()
        for size in {len(w) for w in windows}:
            for j in range(len(words) - size + 1):
                own = windows.get(tuple(words[j : j + size]))
                if own:
                    found |= own
                    hit[j : j + size] = [True] * size
        n = sum(hit)
        out.append((i, len(words), n, len(found), sha(",".join(sorted(found))), n > 0 and 20 * n >= len(words)))
    return sorted(out)


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    s = 0
    while s < min(len(a), len(b)) and a[-1 - s] == b[-1 - s]:
        s += 1
    return p + s >= max(len(a), len(b)) - 1


def lines(docs, near=8):
    blank = re.compile("[ \t\x0b\f\r]+")
    earlier, out = [], []
    for i, text in sorted(docs, key=lambda d: d[0]):
        if text is None:
            out.append((i, None, 0, 0))
            continue
        kept, n, gone, own = [], 0, 0, []
        for line in text.split("\n"):
            words = tuple(w for w in blank.split(line) if w)
            n += bool(words)
            if words and any(words == e or min(len(words), len(e)) >= near and one_edit(words, e) for e in earlier):
                gone += 1
            else:
                kept.append(line)
            if words:
                earlier.append(words)
        out.append((i, "\n".join(kept), n, gone))
    return sorted(out)


def tokens(text):
    """For each word, lower-cased in A-Z: itself and its first four to six bytes, where it has more."""
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").translate(LOWER).encode())
    return [[("word", w), *((n, w[:n]) for n in (4, 5, 6) if len(w) > n)] for w in words]


def log_odds(rows, prior=50.0):
    """Weight and z-score of each token under the Dirichlet prior; ``rows``: (text, label)."""
    count = {0: Counter(), 1: Counter()}
    for text, y in rows:
        count[y].update({t for word in tokens(text) for t in word})
    n1, n0 = (sum(y == k for _, y in rows) for k in (1, 0))
    total = min(prior, (n1 + n0) / 20)
    out = {}
    for t in count[0].keys() | count[1].keys():
        a = (count[0][t] + count[1][t]) * total / (n1 + n0) + 0.01
        one, two = count[1][t] + a, count[0][t] + a
        odds = math.log(one / (n1 + total + 1 - one + a)) - math.log(two / (n0 + total + 1 - two + a))
        out[t] = odds, odds / math.sqrt(1 / one + 1 / two)
    return out


def toxic_evidence(text, weights, drift, decay, rate):
    """Best and total evidence of the maximal-scoring segments, by the definition's scan."""
    score = []
    for word in tokens(text):
        own = [weights[t] for t in word if t in weights]
        up = max(own, default=0)
        score.append(up if up > 0 else min([*own, -drift]))
    sums, found = [0.0], []
    for s in score:
        sums.append(sums[-1] + s)
    for i, s in enumerate(score):
        a, b = i, i + 1
        while s > 0:
            j = next((k for k in reversed(range(len(found))) if sums[found[k][0]] < sums[a]), None)
            if j is None or sums[found[j][1]] >= sums[b]:
                found.append((a, b))
                break
            a = found[j][0]
            del found[j:]
    bits = [decay * (sums[b] - sums[a]) - math.log(rate * max(len(score), 1)) for a, b in found]
    bits = [x for x in bits if x > 0]
    return max(bits, default=0.0), sum(bits)


def statistics(text):
    """What the quality classifier looks at, counted by hand."""
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0d]+", data)
    lines = re.findall(rb"[^\n]+", data)
    n, some, size, rows = len(words), max(len(words), 1), max(len(data), 1), max(len(lines), 1)
    share = lambda chars: sum(b in chars for b in data) / size
    triples = {tuple(words[k : k + 3]) for k in range(n - 2)}
    tail = words[n // 2 :]
    return [
        math.log1p(n),
        sum(map(len, words)) / some,
        share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        share(b"0123456789"),
        share(b".,;:?'\"()-"),
        share(b"#*$%&<>{}[]\\/=+_~^@"),
        share(b"|"),
        share(b"!"),
        len(set(words)) / some,
        len(triples) / max(n - 2, 1),
        max(Counter(words).values(), default=0) / some,
        1 - len(set(lines)) / rows,
        math.log1p(n / rows),
        sum(len(w) > 20 for w in words) / some,
        sum(len(w) <= 3 for w in words) / some,
        len(set(tail)) / max(n - n // 2, 1),
    ]


def isotonic(y):
    """The non-decreasing fit by its max-min formula."""
    return [max(min(sum(y[a : b + 1]) / (b + 1 - a) for b in range(i, len(y))) for a in range(i + 1)) for i in range(len(y))]
