"""Quality rules: a threshold table compiled into one projection (operator 6).

The rules compare lengths and ratios of a text with bounds.  They are a table
(``RULES``), and ``evaluate`` compiles it, with the measures it names, into column
expressions of built-in functions, evaluated in one pass over each row: no user function,
no shuffle.  (The expressions lie in steps, so that none is computed twice.)

Defined results: a null text has no words and counts like an empty one; both fail the
base rule; repeated rows are judged each; an empty table gives no rows; other columns are
kept, except that those named like a result are replaced.  Nothing is quadratic in a
text: repeats are found by sorting hashes of 64 bits of the three words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of the languages of the corpus that occur in almost any prose.
#: Common function words of English, French, German and Spanish.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "with", "as", "be", "by", "are", "this", "or", "at", "from", "not", "have", "an"],
    "fr": ["le", "la", "les", "de", "des", "et", "un", "une", "en", "est", "que", "pour", "dans", "qui", "sur", "au", "du", "pas", "par", "ne", "se", "il"],
    "de": ["der", "die", "das", "und", "in", "den", "von", "zu", "mit", "ist", "auf", "im", "ein", "eine", "nicht", "sich", "es", "dem", "des", "für", "als"],
    "es": ["el", "la", "los", "las", "de", "y", "en", "un", "una", "que", "es", "por", "con", "para", "se", "del", "al", "lo", "su", "no"],
}

#: (measure, least, most): a text is kept if every measure lies within its bounds.
RULES = [
    ("mean_word_chars", 2.0, 16.0),
    ("symbol_ratio", 0.0, 0.10),
    ("dup_line_ratio", 0.0, 0.40),
    ("stop_word_ratio", 0.005, None),
    ("upper_ratio", 0.0, 0.40),
    ("mark_ratio", 0.0, 0.50),
    ("distinct_word_ratio", 0.15, None),
]

#: Columns of the result.
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed_rules", "kept")
#: Low bits of a key that hold the place of a window; the others are those of its hash.
PLACE_BITS = 31

_SPACE = " \t\n\x0b\x0c\r"


def measures(text: Column) -> dict[str, Column]:
    """First-level measures of a text; they name nothing but the text."""
    words = F.array_remove(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, _SPACE, "") != "")
    signs = "#*$%&|<>"
    return {
        "words": words,
        "lines": lines,
        "word_chars": F.length(F.translate(text, _SPACE, "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, signs, "")),
        "n_upper": F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")),
        "n_marks": F.length(text) - F.length(F.translate(text, "!?", "")),
    }


def _suspects() -> Column:
    """(h, at) of the windows whose sorted key has a neighbour with the same bits of the hash, in order."""
    same = f"element_at(_keys, {{}}) >> {PLACE_BITS} = k >> {PLACE_BITS}"
    at = f"cast(k & {(1 << PLACE_BITS) - 1}L as int)"
    return F.expr(f"sort_array(transform(filter(_keys, (k, i) -> (i > 0 and {same.format('i')}) or (i + 1 < size(_keys) and {same.format('i + 2')})), k -> named_struct('h', _hashes[{at}], 'at', {at})))")


def _repeat_words() -> Column:
    """Words in three-word windows that occur more than once: equal hashes of suspects meet by sorting."""
    return F.expr(
        """aggregate(
            sort_array(transform(
                filter(_suspects, (t, i) -> (i > 0 and element_at(_suspects, i).h = t.h) or (i + 1 < size(_suspects) and element_at(_suspects, i + 2).h = t.h)),
                t -> t.at)),
            named_struct('n', 0L, 'next', 0),
            (s, at) -> named_struct('n', s.n + least(3, at + 3 - s.next), 'next', at + 3),
            s -> s.n)"""
    )


def _once(df: DataFrame, columns: list[Column]) -> DataFrame:
    """The columns of ``df`` in ``_others``, and ``columns``, computed once a row whatever later filters name them.

    A filter on a plain projection is pushed below it with the expressions put in
    for the names, here into the loops over a text's words; it stops at a generator.
    """
    return df.select("_others", F.explode(F.array(F.struct(*columns))).alias("_once")).select("_others", "_once.*")


def evaluate(docs: DataFrame, rules: list[tuple[str, float | None, float | None]] = RULES, *, text_column: str = "text") -> DataFrame:
    """``docs`` without its text, with the measures and verdicts of each row.

    Columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed, kept, and failed_rules (the measures out of bounds).
    """
    names = [c for c in docs.columns if c not in (text_column, *RESULTS)]
    packed = docs.select(F.struct(F.lit(0).alias("_"), *(F.col(c).alias(f"_{k}") for k, c in enumerate(names))).alias("_others"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    first = _once(packed, [v.alias(f"_{k}") for k, v in measures(F.col("_text")).items()])
    stops = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words}))
    second = _once(
        first,
        [
            F.size("_words").cast("long").alias("n_words"),
            F.col("_word_chars").cast("long").alias("word_chars"),
            F.col("_n_symbols").cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.size("_lines").alias("_n_lines"),
            F.size(F.array_distinct("_words")).alias("_distinct"),
            F.expr(f"size(filter(_words, w -> w in ({stops})))").alias("_stops"),
            F.col("_n_upper"),
            F.col("_n_marks"),
            F.expr("transform(if(size(_words) < 3, cast(array() as array<int>), sequence(0, size(_words) - 3)), i -> xxhash64(_words[i], _words[i + 1], _words[i + 2]))").alias("_hashes"),
        ],
    )
    counted = [F.col(c) for c in second.columns if c not in ("_others", "_hashes")]
    third = _once(second, [*counted, F.col("_hashes"), F.expr(f"sort_array(transform(_hashes, (h, i) -> h & {-(1 << PLACE_BITS)}L | i))").alias("_keys")])
    third = _once(third, [*counted, _suspects().alias("_suspects")])
    third = _once(third, [*counted, _repeat_words().alias("n_repeat_words")])
    words = F.greatest(F.col("n_words"), F.lit(1))
    ratios = {
        "mean_word_chars": F.col("word_chars") / words,
        "symbol_ratio": F.col("n_symbols") / words,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)),
        "stop_word_ratio": F.col("_stops") / words,
        "upper_ratio": F.col("_n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
        "mark_ratio": F.col("_n_marks") / words,
        "distinct_word_ratio": F.col("_distinct") / words,
    }
    failed = []
    for measure, least, most in rules:
        value = ratios[measure]
        out = [value < least] if least is not None else []
        out += [value > most] if most is not None else []
        if out:
            failed.append(F.when(out[0] if len(out) == 1 else out[0] | out[1], F.lit(measure)))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    others = [F.col("_others")[f"_{k}"].alias(c) for k, c in enumerate(names)]
    fourth = third.select(*others, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), F.array_compact(F.array(*failed)).alias("failed_rules"))
    return fourth.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
