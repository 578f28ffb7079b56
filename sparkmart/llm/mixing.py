"""Mix sources to target weights: random order, prefix sums, exact cuts, repeated epochs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import numbered, running_sums, word_count

WEIGHTS = (5, 2, 1)
SHARE_PCT = 150
MAX_EPOCHS = 2


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_pct: int = SHARE_PCT,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """Words each source may give: one row per source (``_null``, ``_source``), with ``target``.

    Sources in code-point order, null last, take the weights in turn and share ``share_pct``
    percent of all words. A target stops at ``max_epochs`` times its source's words and the excess
    goes to the others by weight, until none is above. That fixed point is a water level: in the
    order of words per weight, the sources up to some place are full and the others share the rest.
    All sums are whole numbers, so the level does not depend on the order of addition.
    The windows without keys run over one row per source.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    sources = (
        sizes.groupBy("_null", "_source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("_rank", F.row_number().over(Window.orderBy("_null", "_source")) - 1)
        .withColumn("_weight", cycle[F.col("_rank") % len(weights)].cast("long"))
    )
    everything = Window.partitionBy()
    by_level = Window.orderBy(F.col("source_size") / F.col("_weight"), "_rank")
    upto = by_level.rowsBetween(Window.unboundedPreceding, 0)
    # level if the sources before this one are full: (share - full) / weights from here on
    levels = sources.select(
        "*",
        (
            share_pct * F.sum("source_size").over(everything)
            - 100 * max_epochs * (F.sum("source_size").over(upto) - F.col("source_size"))
        ).alias("_left"),
        (100 * (F.sum("_weight").over(everything) - F.sum("_weight").over(upto) + F.col("_weight"))).alias("_over"),
    )
    # the first source that the level does not fill; all after it are not filled either
    open_ = F.col("_left") * F.col("_weight") / F.col("_over") <= max_epochs * F.col("source_size")
    first_open = F.min(F.when(open_, F.struct("_place", "_left", "_over"))).over(everything)
    return (
        levels.withColumn("_place", F.row_number().over(by_level))
        .withColumn("_first", first_open)
        .select(
            "_null",
            "_source",
            "source_size",
            F.when(
                F.col("_first").isNotNull() & (F.col("_place") >= F.col("_first._place")),
                (F.col("_first._left") * F.col("_weight")) / F.col("_first._over"),
            )
            .otherwise((max_epochs * F.col("source_size")).cast("double"))
            .alias("target"),
        )
    )


def _sized(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(
        *more,
        F.col("doc_id"),
        word_count(F.col("text")).alias("size"),
        F.col("source").isNull().alias("_null"),
        F.coalesce(F.col("source"), F.lit("")).alias("_source"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("_key"),
        F.xxhash64("text").alias("_text_key"),
    )


def mix_plan(docs: DataFrame, whole: bool = False, carry: Sequence[str] = (), **targets) -> DataFrame:
    """How many words of each document the mix takes (``taken``), with its source's figures.

    The documents of a source stand in a random order that only depends on their ids (a hash).
    Whole epochs are taken as long as the budget lasts; prefix sums of the words cut the last one
    where the budget ends. With ``whole`` the document at the cut is taken or left as a whole,
    whichever is nearer, and ``epochs`` says how often each document is taken; otherwise the cut falls
    inside it and a source's ``taken`` add up to its target, rounded down.

    Size of a null or empty text: 0, and nothing is taken of it but the epochs (it comes along with
    the rows before it). Null source: a source of its own, last. Equal ids are ordered by
    text; equal rows share a place, and which of them is cut makes no difference. Empty table: no rows.
    Other columns are not read, and very long texts are only counted. Targets are one row per source, in one task.
    """
    sized = _sized(docs, *carry)
    goals = source_targets(sized.select("_null", "_source", "size"), **targets)
    placed = running_sums(sized, ["_null", "_source"], ["_key", "_text_key", "size"], ["size"], "mix-ranges")
    # one row per source; the planner broadcasts it where its size at run time allows
    rows = placed.join(goals, ["_null", "_source"]).withColumn("_budget", F.floor("target").cast("long"))
    full = F.when(F.col("source_size") > 0, F.expr("_budget div source_size")).otherwise(F.lit(0))
    rows = rows.withColumn("_full", full.cast("long")).withColumn(
        "_rest", F.col("_budget") - F.col("_full") * F.col("source_size")
    )
    part = F.greatest(F.lit(0), F.least(F.col("_rest") - F.col("size_before"), F.col("size")))
    if whole:
        part = F.when(part * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    into_last = (F.col("size_before") < F.col("_rest")) & ((part > 0) | (F.col("size") == 0))
    return rows.select(
        *carry,
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("_full") * F.col("size") + part).cast("long").alias("taken"),
        (F.col("_full") + into_last.cast("long")).alias("epochs"),
    )


def mix(docs: DataFrame, **targets) -> DataFrame:
    """The mixed documents themselves, with the columns they came with.

    A document is left out, kept, or repeated once per epoch it is taken in; texts stay whole, so
    a source misses its target by half a document at most. Cases as in ``mix_plan``; other columns, whatever their
    names, come back as they were, and very long texts are only counted.
    """
    rows = numbered(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("held")), "mix-rows", "_mix_row")
    plan = mix_plan(rows.select("held.doc_id", "held.text", "held.source", "_mix_row"), whole=True, carry=["_mix_row"], **targets)
    copies = plan.where("epochs > 0").select("_mix_row", F.explode(F.sequence(F.lit(1), F.col("epochs"))).alias("_epoch"))
    return rows.join(copies, "_mix_row").select("held.*")
