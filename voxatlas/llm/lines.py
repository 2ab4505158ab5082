"""Line deduplication within an edit bound (operator 10), in DataFrame operations only.

A line is its sequence of words.  A line goes if an earlier line (by doc_id, then by
place in the text) is equal, or, where both have ``near_words`` words or more, is one
word's insertion, deletion or substitution away.  The earliest stays; what counts is
the input, not what other removals leave.

Equal lines meet by hash.  For near lines the deletion neighbourhood is joined: every
line emits the keys of all its variants with one word left out, and two lines are
within the bound exactly if a variant of both is equal at the same place (a
substitution) or a variant of one is the other (an insertion or deletion).  A variant's
key is an XOR of hashes of words with their places, so that all variants of a line come
from two running XORs.  Before that, lines that cannot have a partner are put aside:
one edit leaves a half of a line, at its beginning or its end, as it was, so only lines
that share such a half with another one emit variants, and only for places in the rest.
Each group of equal variants is compared with its earliest line alone, and every such
pair is verified word by word.

Texts are shuffled only where a line is looked at again or goes: the documents in
question are told apart before the shuffle by a filter of fixed size.

Defined results: a null text stays null; lines without words stay and are not counted;
a text whose lines all go becomes empty; rows with a null doc_id are left as they are
and remove nothing; rows that repeat an id are ordered by their text's hash, and equal
ones lose the same lines; an empty table gives no rows.  Other columns are kept, except
that n_lines and n_removed are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxatlas.llm.common import keep, maybe_among, settled

#: Words that two lines need to be near rather than equal.
NEAR_WORDS = 8


def _plain(line: Column) -> Column:
    """The words of a line, one blank between two; most lines are written so already."""
    odd = line.startswith(" ") | line.endswith(" ")
    for c in ("  ", "\t", "\x0b", "\f", "\r"):
        odd = odd | line.contains(c)
    return F.when(odd, F.trim(F.regexp_replace(line, "[ \\t\\x0B\\f\\r]+", " "))).otherwise(line)


def _half_sizes() -> str:
    """Sizes of the halves of a line of n words: for partners as long or longer, and for shorter ones.

    A size stays the same over four lengths, so that few lines need two.
    """
    return "if(n % 4 = 0, array(n div 4 * 2, n div 4 * 2 - 2), array(n div 4 * 2))"


def line_table(docs: DataFrame, near_words: int) -> DataFrame:
    """(doc_id, row, pos, n, x, y, halves) of each line with words; x and y identify it.

    ``halves`` are the hashes of the first and last words, for each size of half in turn.
    """
    lines = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    words = lines.select("doc_id", "row", "pos", _plain(F.col("line")).alias("line")).where("line <> ''").withColumn("n", F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "))) + 1)

    def halves(size: str) -> str:
        return f"xxhash64('first', {size}, substring_index(line, ' ', {size})), xxhash64('last', {size}, substring_index(line, ' ', -({size})))"

    long, short = halves("n div 4 * 2"), halves("n div 4 * 2 - 2")
    found = F.expr(f"case when n < {near_words} then cast(array() as array<bigint>) when n % 4 = 0 and n > {near_words} then array({long}, {short}) else array({long}) end")
    return words.select("doc_id", "row", "pos", "n", F.xxhash64("line").alias("x"), F.xxhash64(F.lit("y"), "line").alias("y"), found.alias("halves"))


def _candidates(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(x, y, first, n, words, head, tail) of the distinct lines that share a half with another one.

    Variants are needed from place ``head`` on and before place ``tail``.
    """
    halves = distinct.select("x", "y", "n", F.posexplode("halves").alias("k", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("lines")).where("lines > 1").select("half")
    size = F.expr("n div 4 * 2 - if(k > 1, 2, 0)")
    some = halves.join(shared, "half").groupBy("x", "y").agg(F.min(F.when(F.col("k") % 2 == 0, size)).alias("head"), F.min(F.when(F.col("k") % 2 == 1, size)).alias("tail"))
    some = keep(some.join(distinct.select("x", "y", "first"), ["x", "y"]))
    wanted = some.select(F.col("first.doc_id").alias("doc_id"), F.col("first.row").alias("row"), F.col("first.pos").alias("pos"), "x", "y", "head", "tail")
    texts = maybe_among(docs.select("doc_id", F.xxhash64("text").alias("row"), "text"), F.struct("doc_id", "row"), wanted, F.struct("doc_id", "row")).where("_maybe").drop("_maybe").dropDuplicates(["doc_id", "row"])
    lines = texts.join(wanted.groupBy("doc_id", "row").agg(F.collect_list(F.struct("pos", "x", "y", "head", "tail")).alias("wanted")), ["doc_id", "row"])
    lines = lines.select("doc_id", "row", F.split("text", "\n", -1).alias("lines"), F.explode("wanted").alias("l"))
    words = F.split(_plain(F.col("lines")[F.col("l.pos")]), " ")
    return lines.select("l.x", "l.y", F.struct("doc_id", "row", "l.pos").alias("first"), "l.head", "l.tail", words.alias("words")).withColumn("n", F.size("words"))


def near_lines(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(x, y) of the distinct lines that have an earlier line one edit away."""
    lines = keep(_candidates(docs, distinct))
    places = lines.select("x", "y", "n", "head", "tail", F.posexplode("words").alias("at", "word"))
    line = "partition by x, y"
    before = F.expr(f"coalesce(bit_xor(xxhash64(word, at)) over ({line} order by at rows between unbounded preceding and 1 preceding), 0L)")
    after = F.expr(f"bit_xor(xxhash64(word, at - 1)) over ({line}) ^ bit_xor(xxhash64(word, at - 1)) over ({line} order by at rows between unbounded preceding and current row)")
    whole = F.expr(f"bit_xor(xxhash64(word, at)) over ({line})")
    hashed = places.select("x", "y", "n", "at", "head", "tail", whole.alias("whole"), before.alias("before"), after.alias("after"))
    variant = F.when((F.col("at") >= F.col("head")) | (F.col("at") < F.col("n") - F.col("tail")), F.struct("at", F.expr("before ^ after").alias("h")))
    line_itself = F.when(F.col("at") == 0, F.struct(F.lit(-1).alias("at"), F.col("whole").alias("h")))
    keys = keep(hashed.select("x", "y", "n", F.explode(F.array_compact(F.array(variant, line_itself))).alias("v")).select("x", "y", "n", "v.at", "v.h"))

    # equal keys of different lines; of a line that repeats its words one place is enough
    equal = keys.groupBy("h").agg(F.min("x").alias("a"), F.max("x").alias("b")).where("a <> b").select("h")
    met = keep(keys.join(equal, "h").join(lines.select("x", "y", "first"), ["x", "y"]))

    group = met.where("at >= 0").groupBy("n", "at", "h").agg(F.min(F.struct("first", "x", "y")).alias("e"))
    replaced = met.join(group, ["n", "at", "h"]).where("e.first < first").select("x", "y", "e.x", "e.y").toDF("x", "y", "ex", "ey")
    shorter = met.where("at < 0").select("h", F.col("n").alias("m"), F.col("x").alias("sx"), F.col("y").alias("sy"), F.col("first").alias("s_first"))
    grown = met.where("at >= 0").withColumn("m", F.col("n") - 1).join(shorter, ["h", "m"])
    later = grown.where("s_first < first").select("x", "y", F.col("sx").alias("ex"), F.col("sy").alias("ey"))
    sooner = grown.where("first < s_first").groupBy("sx", "sy").agg(F.min(F.struct("first", "x", "y")).alias("e")).select("sx", "sy", "e.x", "e.y").toDF("x", "y", "ex", "ey")

    pairs = replaced.unionAll(later).unionAll(sooner).distinct()
    texts = lines.select("x", "y", "words")
    both = pairs.join(texts, ["x", "y"]).join(texts.toDF("ex", "ey", "others"), ["ex", "ey"])
    return both.where(_one_edit("words", "others")).select("x", "y").distinct()


def _one_edit(a: str, b: str) -> Column:
    """Whether two word arrays are at most one word's edit apart: their equal ends leave one word at most."""
    longest = f"greatest(size({a}), size({b}))"

    def equal_words(one: str, two: str) -> str:
        return f"coalesce(nullif(array_position(zip_with({one}, {two}, (u, v) -> coalesce(u = v, false)), false), 0) - 1, {longest})"

    return F.expr(f"abs(size({a}) - size({b})) <= 1 and {longest} - 1 <= {equal_words(a, b)} + {equal_words(f'reverse({a})', f'reverse({b})')}")


def removed_lines(docs: DataFrame, near_words: int = NEAR_WORDS) -> DataFrame:
    """(doc_id, row, pos) of the lines that go."""
    lines = keep(line_table(docs, near_words))
    distinct = keep(lines.groupBy("x", "y").agg(F.min(F.struct("doc_id", "row", "pos")).alias("first"), F.any_value("n").alias("n"), F.any_value("halves").alias("halves"), F.count("*").alias("times")))
    near = near_lines(docs, distinct).withColumn("near", F.lit(True))
    going = keep(distinct.where("times > 1").select("x", "y", "first").join(near, ["x", "y"], "full"))
    met = lines.select("doc_id", "row", "pos", "x", "y").join(going, ["x", "y"])
    return met.where(F.col("near") | (F.struct("doc_id", "row", "pos") != F.col("first"))).select("doc_id", "row", "pos")


def dedup_lines(docs: DataFrame, near_words: int = NEAR_WORDS) -> DataFrame:
    """``docs`` with the lines that go taken out of the text, and n_lines, n_removed."""
    gone = settled(lambda: removed_lines(docs.select("doc_id", "text"), near_words).groupBy("doc_id", "row").agg(F.collect_set("pos").alias("_gone")))
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # names of other columns may be those used here
    packed = docs.select("doc_id", "text", F.xxhash64("text").alias("row"), F.struct(*names).alias("_all"))
    marked = maybe_among(packed, F.struct("doc_id", "row"), gone, F.struct("doc_id", "row"))
    shuffled = marked.where("_maybe").join(gone, ["doc_id", "row"], "left").select("text", "_all", "_gone")
    rows = shuffled.unionByName(marked.where("not _maybe").select("text", "_all", F.lit(None).cast("array<int>").alias("_gone")))
    left = F.expr("case when _gone is null then text else array_join(transform(array_except(sequence(0, size(split(text, '\\n', -1)) - 1), _gone), i -> _lines[i]), '\\n') end")
    counted = rows.withColumn("_lines", F.split("text", "\n", -1))
    n_lines = F.size(F.filter(F.coalesce("_lines", F.array().cast("array<string>")), lambda x: F.trim(x, F.lit(" \t\x0b\f\r")) != ""))
    return counted.select(*(left.alias(c) if c == "text" else F.col("_all")[c].alias(c) for c in names), n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"))
