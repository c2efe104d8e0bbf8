"""Quality rules: a table of thresholds compiled into one Spark projection.

``RULES`` lists ratios of per-document measures with the bounds they must keep
(length, symbols, stop words, lines). ``verdict`` turns the table into one Boolean
expression; the measures are built-in array and string functions over the whole text.
There is no user function and no shuffle: every document is judged by itself.

Defined results: a null text has no words and fails; repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20            # of the base rule
MAX_REPEAT_PERCENT = 30   # of the base rule
WINDOW = 8

# Frequent function words of the four languages of the corpus (fixed values).
STOP_WORDS = (
    "the of and to in that is for with as by this on at be are it from was "
    "le la les de des et un une du que qui dans est pour sur au avec par pas en "
    "der die das und in zu den von ist mit sich ein eine nicht auf im dem "
    "el la los las de que en un una por con para del se no es y"
).split()


@dataclass(frozen=True)
class Rule:
    """``low * of <= measure + slack`` and ``measure <= high * of`` (None: no bound)."""
    name: str
    measure: str
    of: str
    low: float | None = None
    high: float | None = None
    slack: int = 0


RULES = (
    Rule("mean word length", "word_chars", "n_words", low=2.5, high=15),
    Rule("symbols per word", "n_symbols", "n_words", high=0.1),
    Rule("shouts per word", "n_shouts", "n_words", high=0.5),
    Rule("stop words", "n_stop_words", "n_words", low=0.02, slack=1),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=0.5),
)


def verdict(rules=RULES) -> Column:
    """The threshold table as one Boolean column over the measures."""
    ok = F.lit(True)
    for r in rules:
        measure, of = F.col(r.measure), F.col(r.of)
        if r.low is not None:
            ok = ok & (F.lit(r.low) * of <= measure + F.lit(r.slack))
        if r.high is not None:
            ok = ok & (measure <= F.lit(r.high) * of)
    return ok


def words_of(text: str = "text") -> Column:
    """Words between ASCII white space, in order."""
    return F.array_remove(F.split(F.translate(F.coalesce(F.col(text), F.lit("")), "\t\n\x0b\x0c\r", "     "), " "), "")


def _shifted(a: str, by: int) -> Column:
    """Pair hashes of array ``a`` with itself ``by`` places on."""
    n = F.greatest(F.lit(0), F.size(a) - by)
    return F.zip_with(F.slice(a, 1, n), F.slice(a, by + 1, n), lambda x, y: F.xxhash64(x, y))


def measures(docs: DataFrame) -> DataFrame:
    """Adds the per-document measures to documents with a ``text`` column (as columns prefixed by nothing
    else than their names; an input column of such a name is replaced). All other columns travel in one
    struct, so no name of theirs can meet a name used here."""
    long = "long"
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                     F.coalesce("text", F.lit("")).alias("_t"))
    df = df.withColumn("_w", words_of("_t"))
    df = df.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != ""))
    # hashes of all 8-word windows by doubling: 1 -> 2 -> 4 -> 8 words
    df = df.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    for k, by in enumerate((1, 2, 4)):
        df = df.withColumn("_h", _shifted("_h", by))
    df = df.withColumn("_again", F.size("_h") > F.size(F.array_distinct("_h")))
    # places of windows that occur twice: sort (hash, place), keep what equals a neighbour
    df = df.withColumn("_s", F.when(F.col("_again"), F.array_sort(
        F.transform("_h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    df = df.withColumn("_p", F.expr("""array_sort(flatten(zip_with(
        slice(_s, 1, size(_s) - 1), slice(_s, 2, size(_s) - 1),
        (a, b) -> if(a.x = b.x, array(a.i, b.i), cast(array() as array<int>)))))"""))
    df = df.withColumn("_p", F.array_distinct("_p"))
    df = df.withColumn("n_repeat_words", F.when(F.col("_again"), F.expr(f"""{WINDOW} + aggregate(zip_with(
        slice(_p, 1, size(_p) - 1), slice(_p, 2, size(_p) - 1), (a, b) -> least({WINDOW}, b - a)),
        0, (s, x) -> s + x)""")).otherwise(0).cast(long))
    stop = sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)})
    df = df.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in MEASURES],
        F.size("_w").cast(long).alias("n_words"),
        F.length(F.array_join("_w", "")).cast(long).alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast(long).alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast(long).alias("n_dup_lines"),
        "n_repeat_words",
        F.size("_l").cast(long).alias("n_lines"),
        (F.length("_t") - F.length(F.replace("_t", F.lit("!"), F.lit("")))).cast(long).alias("n_shouts"),
        F.size(F.filter("_w", lambda w: w.isin(stop))).cast(long).alias("n_stop_words"))
    return df


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts",
            "n_stop_words")


def judged(docs: DataFrame, rules=RULES) -> DataFrame:
    """Documents with their measures, ``base_failed`` and ``kept``."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measures(docs.drop("base_failed", "kept")).withColumn("base_failed", base).withColumn(
        "kept", ~base & verdict(rules))


def keep_good(docs: DataFrame, rules=RULES) -> DataFrame:
    """The documents that pass, with their own columns only."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "text")
    # a condition that is not deterministic (and never true) keeps the optimizer from copying the whole
    # computation of the measures into the filter, once for every place that refers to it
    out = judged(whole, rules).withColumn("kept", F.col("kept") | (F.monotonically_increasing_id() < 0)).filter("kept")
    return out.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
