"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells (source, language, topic) of tokens. The cells' shares are
raked: scaled in turn to the target shares of the sources, the languages and the topics,
until all three margins hold. Each cell then has a calibrated probability
``min(1, scale * raked share / tokens)``, with the scale at which the expected number of
kept tokens is ``keep_share`` of all, and a document stays if a hash of its doc_id falls
below its cell's probability - the same documents on every run and after lost tasks.

DataFrame functions only. The documents are read for the sums and once more to be
sampled; everything between works on the cell table, whose size is the number of
(source, language, topic) combinations.

Default targets temper the present shares (share ** exponent, renormalised), which lifts
small sources and languages; explicit ones can be given per dimension.

Documents have no topic column, so without one ``topic_of`` derives a coarse one from
the form of the text.

Defined results: a null in a dimension is the level ""; a null text has no tokens and is
sampled like its cell, a cell without any tokens is kept; repeated rows are sampled alike (same doc_id); a
null doc_id is hashed as the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelterlens.llm.quality_rules import words_of
from shelterlens.session import materialize

DIMENSIONS = ("source", "lang", "topic")
EXPONENTS = {"source": 0.5, "lang": 0.7, "topic": 1.0}
KEEP_SHARE = 0.6
TOLERANCE = 1e-6
SWEEPS_A_JOB = 4
MAX_JOBS = 15


def topic_of(tokens: str = "n_tokens") -> Column:
    """Coarse topic from the form of the text: list, note, article or long read."""
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n"))
    return (F.when(F.col(tokens) < 8 * lines, "list").when(F.col(tokens) < 150, "note")
            .when(F.col(tokens) < 600, "article").otherwise("long read"))


def with_cells(docs: DataFrame) -> DataFrame:
    """Adds n_tokens and the three dimensions (as _source, _lang, _topic)."""
    df = docs.withColumn("n_tokens", F.size(words_of()).cast("long"))
    topic = F.col("topic").cast("string") if "topic" in docs.columns else topic_of()
    return df.withColumns({"_source": F.coalesce(F.col("source").cast("string"), F.lit("")),
                           "_lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
                           "_topic": F.coalesce(topic, F.lit(""))})


def _over(*names: str) -> str:
    return f"partition by {', '.join(names)}"


def targets(cells: DataFrame, given: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Cells with t_source, t_lang, t_topic: the share each level shall have (they sum to 1 per dimension).

    ``given`` maps a dimension to target weights by level; levels it leaves out get none.
    """
    given = given or {}
    for d in DIMENSIONS:
        margin = cells.groupBy(f"_{d}").agg(F.sum("tokens").alias("m"))
        if d in given:
            weight = F.lit(0.0)
            for level, w in given[d].items():
                weight = F.when(F.col(f"_{d}") == level, F.lit(float(w))).otherwise(weight)
        else:
            weight = F.pow(F.col("m").cast("double"), F.lit(EXPONENTS[d]))
        margin = margin.select(f"_{d}", weight.alias("w"))   # a row per level
        margin = margin.selectExpr(f"_{d}", f"coalesce(try_divide(w, sum(w) over ()), 0D) as t_{d}")
        cells = cells.join(margin, f"_{d}")
    return cells


def rake(cells: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Cells (_source, _lang, _topic, tokens, t_*) with ``share``: fitted to all three margins.

    Sweeps scale to one margin after the other (a window sum per level of the cell
    table); every few sweeps the table is stored and the largest error of a margin read.
    Margins that no scaling can meet (a level without cells that others allow) end at
    the last sweep.
    """
    now = cells.withColumn("share", F.expr("tokens / greatest(1, sum(tokens) over ())").cast("double"))
    for _ in range(MAX_JOBS):
        for _ in range(SWEEPS_A_JOB):
            for d in DIMENSIONS:
                now = now.withColumn("share", F.expr(
                    f"coalesce(share * t_{d} / nullif(sum(share) over ({_over(f'_{d}')}), 0), 0D)"))
        now = materialize(now)
        worst = 0.0
        for d in DIMENSIONS:
            worst = max(worst, now.groupBy(f"_{d}", f"t_{d}").agg(F.sum("share").alias("s")).agg(
                F.max(F.abs(F.col("s") - F.col(f"t_{d}")))).first()[0] or 0.0)
        if worst <= tolerance:
            break
    return now


def probabilities(cells: DataFrame, keep_share: float = KEEP_SHARE) -> DataFrame:
    """Raked cells with ``probability``; capped cells pass what they lack on to the others.

    With cells in order of share / tokens, descending, the first k are kept whole; the
    scale for the rest follows from what is left of the budget, and the right k is the
    least one whose next cell stays below 1.
    """
    order = "order by share / tokens desc, _source, _lang, _topic rows between unbounded preceding and 1 preceding"
    full = cells.filter("tokens > 0").selectExpr(
        "*", f"coalesce(sum(tokens) over ({order}), 0) as whole", f"coalesce(sum(share) over ({order}), 0D) as used",
        f"{keep_share}D * sum(tokens) over () as budget", "sum(share) over () as all_share")
    # the scale if this cell and those after it are the ones not kept whole
    full = full.selectExpr("*", "coalesce((budget - whole) / nullif(all_share - used, 0), 0D) as scale")
    full = full.selectExpr("*", "scale * share / tokens as p")
    # least k: the first cell with p < 1; all before it are kept whole
    return full.selectExpr("_source", "_lang", "_topic", "tokens", "share", "t_source", "t_lang", "t_topic",
                           "max(case when p <= 1 then struct(-whole as w, scale as s) end) over () as best").selectExpr(
        "_source", "_lang", "_topic", "tokens", "share", "t_source", "t_lang", "t_topic",
        "round(least(1D, greatest(0D, coalesce(best.s, 1e300D) * share / tokens)), 9) as probability")


OWN = ("n_tokens", "probability", "kept", "_source", "_lang", "_topic")    # columns that sampling adds


def sampled(docs: DataFrame, given=None, keep_share: float = KEEP_SHARE) -> DataFrame:
    """Documents with n_tokens, their cell (``_source``, ``_lang``, ``_topic``), its ``probability`` and ``kept``;
    input columns of these names are replaced."""
    with_dims = with_cells(docs.drop(*OWN))
    cells = materialize(with_dims.groupBy("_source", "_lang", "_topic").agg(F.sum("n_tokens").alias("tokens")))
    found = materialize(probabilities(rake(targets(cells, given)), keep_share))
    dims = ["_source", "_lang", "_topic"]
    chance = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 12), 16, 10
                    ).cast("double") / float(16 ** 12)
    return (with_dims.join(found.select(*dims, "probability"), dims, "left")
            .withColumn("probability", F.coalesce("probability", F.lit(1.0)))
            .withColumn("kept", chance < F.col("probability")))


def keep_mixed(docs: DataFrame, given=None, keep_share: float = KEEP_SHARE) -> DataFrame:
    """The sampled documents, with their own columns only (they travel in one struct, so any names will do)."""
    needed = [c for c in ("doc_id", "text", "source", "lang", "topic") if c in docs.columns]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *needed)
    out = sampled(whole, given, keep_share).filter("kept")
    return out.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
