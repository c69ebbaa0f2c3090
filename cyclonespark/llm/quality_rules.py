"""Quality rules [native]: a threshold table compiled into one projection.

``measure`` computes the counts of a text, ``RULES`` states the thresholds and
``verdict`` turns the table into a single Column; no user function, no shuffle.

Nulls and edge cases: a null or blank text has no words, all counts are 0 and it fails
the base rule (fewer than 50 words); other null columns are passed through; repeated rows
are judged one by one; extra columns are kept by ``score`` unless they carry the name of
a measure, which then holds the measure.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclonespark.llm.common import SPACE, count_chars, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# FIXED VALUES: frequent function words of the four languages of the corpus
STOP_WORDS = (
    "the of and to in is a that it for on was as be with by are this at from or an not "
    "der die das und ist ein eine zu den von mit auf für nicht des im "
    "le la les de des et un une du que qui en est dans pour pas sur "
    "el los las y o un una es por con para del al se no su como"
).split()

#: (ratio, smallest, largest); None: no bound on that side
RULES = (
    ("word_chars / n_words", 2.0, 15.0),
    ("n_symbols / n_words", None, 0.15),
    ("n_stop_words / n_words", 0.04, None),
    ("n_dup_lines / n_lines", None, 0.45),
    ("n_words / n_lines", 2.0, None),
)


def _repeated(grams: Column, n: Column) -> Column:
    """Words covered by a 3-word window that occurs twice or more in the text.

    ``grams`` holds one long per window: the window's hash with its lowest bits replaced
    by the position.  Sorted, equal windows stand side by side.
    """
    bits = F.ceil(F.log2(n + 1)).cast("int")

    def hash_part(x: Column) -> Column:
        return F.call_function("shiftright", x, bits)

    flagged = F.filter(
        grams,
        lambda x, i: (hash_part(x) == hash_part(F.coalesce(F.get(grams, i - 1), F.bitwise_not(x))))
        | (hash_part(x) == hash_part(F.coalesce(F.get(grams, i + 1), F.bitwise_not(x)))),
    )
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1
    at = F.array_sort(F.transform(flagged, lambda x: x.bitwiseAND(mask)))
    start = F.struct(F.lit(0).cast("bigint").alias("covered"), F.lit(-3).cast("bigint").alias("last"))
    return F.aggregate(
        at,
        start,
        lambda acc, p: F.struct((acc["covered"] + F.least(F.lit(3).cast("bigint"), p - acc["last"])).alias("covered"), p.alias("last")),
        lambda acc: acc["covered"],
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of a text: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_stop_words, n_repeat_words.

    A window of three words is compared by a 64-bit hash, of which the lowest bits give
    way to its position (log2 of the word count): within one text of 20,000 words two
    different windows meet with a probability of about 4e-7, of 350 words about 1e-12.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.translate(x, SPACE, "") != "")
    out = docs.withColumn("_words", words(F.col(text))).withColumn("_lines", lines)
    out = out.withColumn("n_words", F.size("_words").cast("long"))
    n, w = F.col("n_words"), F.col("_words")
    bits = F.ceil(F.log2(n + 1)).cast("int")
    window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    packed = lambda i: F.call_function("shiftleft", F.call_function("shiftright", window(i), bits), bits).bitwiseOR(i.cast("bigint"))
    grams = F.sort_array(F.transform(F.sequence(F.lit(0), F.col("n_words").cast("int") - 3), packed))
    none = F.array().cast("array<bigint>")
    out = out.withColumn("_grams", F.when(n >= 3, grams).otherwise(none))
    # arrays of distinct windows need no search for positions
    return out.select(
        *[c for c in docs.columns if c not in MEASURES],
        "n_words",
        (F.length(body) - F.length(F.translate(body, SPACE, ""))).alias("_blank"),
        (F.length(F.translate(body, SPACE, ""))).cast("long").alias("word_chars"),
        count_chars(body, SYMBOLS).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_words", lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        _repeated(F.col("_grams"), n).alias("n_repeat_words"),
    ).drop("_blank")


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_repeat_words")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))


def verdict(rules=RULES) -> Column:
    """The threshold table as one condition; a ratio over 0 is 0."""

    def holds(ratio: str, low, high) -> Column:
        top, bottom = ratio.split(" / ")
        value = F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double")), F.lit(0.0))
        return (F.lit(True) if low is None else value >= low) & (F.lit(True) if high is None else value <= high)

    return reduce(lambda a, b: a & b, (holds(*r) for r in rules))


def score(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept`` (false if the base rule or any threshold fails)."""
    out = measure(docs, text).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` whose verdict is true, in the columns of ``docs``.

    The row number keeps the optimizer from pushing the filter below the projection, where
    it would spell out the word splitting anew inside every rule and lambda.
    """
    scored = score(docs, text, rules).withColumn("_row", F.monotonically_increasing_id())
    return scored.filter(F.col("kept") & (F.col("_row") >= 0)).select(*[c for c in docs.columns if c not in MEASURES])
