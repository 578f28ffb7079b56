"""Quality rules: base rules and robust multivariate outliers per language and source."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import SPACE, WORD, let, words_of
from sparkmart.session import settle

MIN_WORDS = 50
MAX_REPEAT_PCT = 50

GRID = 1024  # vectors are whole numbers of 1/GRID, so that sums do not depend on their order
FLOORS = (0.06, 0.5, 0.5, 0.15)  # least standard deviation of each coordinate
DIMS = len(FLOORS)
HALF_FACTOR = 2.109063  # fixed value: makes the covariance of the nearest half consistent, 0.5 / P(chi2_6 <= median of chi2_4)
REWEIGHT = 11.143287  # fixed value: quantile of chi-square with four degrees of freedom at 0.975
REWEIGHT_FACTOR = 1.064466  # fixed value: the same factor for the rows up to there, 0.975 / P(chi2_6 <= REWEIGHT)
CUTOFF = 33.38  # fixed value: its quantile at 1 - 1e-6; a clean row is rejected once in a million
MIN_GROUP = 60  # smaller groups of one language are pooled, then all that is left
BINS_PER_E = 32  # distances are ranked in bins of 3 percent
MAX_BROADCAST_GROUPS = 10_000  # beyond that, estimates are joined by a shuffle
STARTS = ("median", "all", "half")
FIRST_STEPS, LAST_STEPS, REWEIGHT_STEPS = 2, 3, 2

PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]


def _repeated_words(hashes: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the array."""
    n = F.size(hashes)
    windows = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)),
    )

    def covered(keys: Column) -> Column:
        def starts(ranked: Column) -> Column:
            def twice(x: Column, at: Column) -> Column:
                before, after = F.get(ranked, at - 1)["key"], F.get(ranked, at + 1)["key"]
                return F.coalesce(before == x["key"], F.lit(False)) | F.coalesce(after == x["key"], F.lit(False))

            return F.filter(ranked, twice)

        ranked = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("at"))))
        spread = F.transform(let(ranked, starts), lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2))
        return F.size(F.array_distinct(F.flatten(spread)))

    # most texts repeat no window, which a hash set tells without sorting
    counted = lambda keys: F.when(F.size(F.array_distinct(keys)) == F.size(keys), 0).otherwise(covered(keys))
    return F.when(n < 3, 0).otherwise(let(windows, counted))


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.rlike(line, F.lit(WORD)))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def text_statistics(text: Column) -> Column:
    """Struct of the five counts; a null text has no words, lines or symbols."""
    text = F.coalesce(text, F.lit(""))
    hashes = F.transform(words_of(text), lambda w: F.xxhash64(w))
    return let(
        hashes,
        lambda h: F.struct(
            F.size(h).cast("long").alias("n_words"),
            (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            _duplicate_lines(text).cast("long").alias("n_dup_lines"),
            _repeated_words(h).cast("long").alias("n_repeat_words"),
        ),
    )


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PCT * s["n_words"])


def vector(s: Column) -> Column:
    """Transformed counts on the grid.

    Word length (log, drawn to 5 by 50 pseudo-words, as short texts say little), symbols per word
    and duplicate lines per word (log of one plus percent), repeated words (arcsine of the root of the share).
    """
    n = F.greatest(s["n_words"], F.lit(1)).cast("double")
    parts = [
        F.log((s["word_chars"] + 250) / (n + 50)),
        F.log1p(100 * s["n_symbols"] / n),
        F.log1p(100 * s["n_dup_lines"] / n),
        F.asin(F.sqrt(s["n_repeat_words"] / n)),
    ]
    return F.array(*[F.round(p * GRID).cast("long") for p in parts])


def _with_groups(rows: DataFrame) -> DataFrame:
    """Group of each row: language and source if large enough, else the rest of the language, else the rest."""
    keys = ["_no_lang", "_lang", "_no_source", "_source"]
    sizes = rows.groupBy(*keys).count()
    lang = Window.partitionBy("_no_lang", "_lang")
    small = F.col("count") < MIN_GROUP
    left = F.sum(F.when(small, F.col("count")).otherwise(0)).over(lang)
    own = F.concat_ws("\x1f", F.lit("s"), *[F.col(k).cast("string") for k in keys])
    rest = F.concat_ws("\x1f", F.lit("l"), F.col("_no_lang").cast("string"), F.col("_lang"))
    return sizes.select(
        *keys, F.when(~small, own).when(left >= MIN_GROUP, rest).otherwise(F.lit("rest")).alias("_group")
    )


def _keyed(lang: Column, source: Column) -> dict[str, Column]:
    return {
        "_no_lang": lang.isNull(),
        "_lang": F.coalesce(lang, F.lit("")),
        "_no_source": source.isNull(),
        "_source": F.coalesce(source, F.lit("")),
    }


def _bounded(rows: DataFrame, estimates: DataFrame, keys: list[str]) -> DataFrame:
    """Join few estimates to many rows; broadcast only below a checked number of groups."""
    if estimates.count() <= MAX_BROADCAST_GROUPS:
        estimates = F.broadcast(estimates)
    return rows.join(estimates, keys)


def _factored(moments: DataFrame, keep: list[str], factor: float = 1.0) -> DataFrame:
    """Mean and Cholesky factor of ``factor`` times the covariance (with the floors added) from sums ``n, s_i, s_ij``."""
    n = F.col("n").cast("double")
    out = moments.withColumns({f"m_{i}": F.col(f"s_{i}").cast("double") / n for i in range(DIMS)})
    for i in range(DIMS):
        for j in range(i + 1):
            value = factor * (F.col(f"s_{i}_{j}").cast("double") / n - F.col(f"m_{i}") * F.col(f"m_{j}"))
            for k in range(j):
                value = value - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            if i == j:
                least = (FLOORS[i] * GRID) ** 2
                out = out.withColumn(f"l_{i}_{i}", F.sqrt(F.greatest(value, F.lit(0.0)) + least))
            else:
                out = out.withColumn(f"l_{i}_{j}", value / F.col(f"l_{j}_{j}"))
    logs = sum((F.log(f"l_{i}_{i}") for i in range(1, DIMS)), F.log("l_0_0"))
    names = [f"m_{i}" for i in range(DIMS)] + [f"l_{i}_{j}" for i, j in PAIRS]
    return out.select(*keep, *names, logs.alias("log_det"))


def _distance(v: Column) -> Column:
    """Squared Mahalanobis distance of the vector column from the estimate in the row."""
    solved: list[Column] = []
    for i in range(DIMS):
        rest = v[i] - F.col(f"m_{i}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}_{k}") * solved[k]
        solved.append(rest / F.col(f"l_{i}_{i}"))
    return sum((y * y for y in solved[1:]), solved[0] * solved[0])


def _sums(v: Column) -> list[Column]:
    whole = lambda c: F.sum(c.cast("decimal(19,0)"))
    first = [whole(v[i]).alias(f"s_{i}") for i in range(DIMS)]
    second = [whole(v[i] * v[j]).alias(f"s_{i}_{j}") for i, j in PAIRS]
    return [F.count(F.lit(1)).alias("n"), *first, *second]


def _medians(rows: DataFrame) -> DataFrame:
    """Coordinate-wise median and absolute deviation, from counts of the grid values."""
    long = rows.select("_group", F.posexplode("v").alias("dim", "x"))

    def middle(counts: DataFrame, name: str) -> DataFrame:
        by = Window.partitionBy("_group", "dim")
        upto = F.sum("count").over(by.orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
        ranked = counts.select("*", upto.alias("upto"), F.sum("count").over(by).alias("all"))
        return ranked.where(F.col("upto") * 2 >= F.col("all")).groupBy("_group", "dim").agg(F.min("x").alias(name))

    counts = long.groupBy("_group", "dim", "x").count()
    centre = middle(counts, "median")
    away = counts.join(centre, ["_group", "dim"]).select(
        "_group", "dim", F.abs(F.col("x") - F.col("median")).alias("x"), "count"
    )
    spread = middle(away.groupBy("_group", "dim", "x").agg(F.sum("count").alias("count")), "mad")
    both = centre.join(spread, ["_group", "dim"]).groupBy("_group")
    pick = lambda i, c: F.max(F.when(F.col("dim") == i, F.col(c)))
    least = [F.lit(f * GRID) for f in FLOORS]
    return both.agg(
        *[pick(i, "median").cast("double").alias(f"m_{i}") for i in range(DIMS)],
        *[
            (F.greatest(1.4826 * pick(i, "mad"), least[i]) if i == j else F.lit(0.0)).alias(f"l_{i}_{j}")
            for i, j in PAIRS
        ],
    ).withColumn("start", F.lit("median")).withColumn("log_det", F.lit(0.0))


def _concentrated(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One C-step: the estimate from the (n + p + 1) / 2 rows nearest to the estimate before.

    No larger support withstands junk in nearly half of a group's rows.

    Sums are kept per bin of the distance, so one pass over the rows and one small exchange (groups times
    bins) give the new subset and its moments at once.
    """
    near = _bounded(rows, estimates, ["_group"]).withColumn(
        "bin", F.floor(F.log(_distance(F.col("v")) + 1e-3) * BINS_PER_E)
    )
    bins = near.groupBy("_group", "start", "bin").agg(*_sums(F.col("v")))
    by = Window.partitionBy("_group", "start")
    upto = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    names = ["n", *[f"s_{i}" for i in range(DIMS)], *[f"s_{i}_{j}" for i, j in PAIRS]]
    summed = bins.select(
        "_group", "start", "bin", F.sum("n").over(by).alias("all"), *[F.sum(c).over(upto).alias(c) for c in names]
    ).where(F.col("n") >= F.least("all", F.floor((F.col("all") + DIMS + 1) / 2)))
    first = F.row_number().over(by.orderBy("bin"))
    chosen = summed.withColumn("first", first).where("first = 1")
    return settle(_factored(chosen, ["_group", "start"], HALF_FACTOR), "mcd-step")


def fit_outliers(rows: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimate per group, from rows with ``_group`` and ``v``.

    Three starts that do not depend on chance (medians, all rows, a half chosen by hash of the vector) take
    two C-steps each; the one with the smallest determinant goes on. The rows within REWEIGHT of it
    give the final estimate (twice), which uses more of the clean rows than half.
    """
    starts = rows.select("_group", "v").withColumn(
        "start", F.explode(F.when(F.xxhash64("v") % 2 == 0, F.array(F.lit("all"), F.lit("half"))).otherwise(F.array(F.lit("all"))))
    )
    moments = starts.groupBy("_group", "start").agg(*_sums(F.col("v")))
    found = settle(_medians(rows).unionByName(_factored(moments, ["_group", "start"])), "mcd-start")
    for _ in range(FIRST_STEPS):
        found = _concentrated(rows, found)
    best = F.row_number().over(Window.partitionBy("_group").orderBy("log_det", "start"))
    found = found.withColumn("best", best).where("best = 1").drop("best")
    for _ in range(LAST_STEPS):
        found = _concentrated(rows, found)
    found = found.drop("start", "log_det")
    for _ in range(REWEIGHT_STEPS):
        near = _bounded(rows, found, ["_group"]).where(_distance(F.col("v")) <= REWEIGHT)
        moments = near.groupBy("_group").agg(*_sums(F.col("v")))
        found = settle(_factored(moments, ["_group"], REWEIGHT_FACTOR).drop("log_det"), "mcd")
    return found


def _narrow(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(
        *more,
        text_statistics(F.col("text")).alias("_s"),
        *[c.alias(k) for k, c in _keyed(F.col("lang"), F.col("source")).items()],
    )


def _estimates(stats: DataFrame) -> DataFrame:
    """Estimate for each language and source that has rows which pass the base rules."""
    keys = ["_no_lang", "_lang", "_no_source", "_source"]
    passed = stats.where(~base_failed(F.col("_s")))
    groups = settle(_with_groups(passed), "mcd-groups")
    rows = settle(_bounded(passed.select(*keys, vector(F.col("_s")).alias("v")), groups, keys).select("_group", "v"), "mcd-rows")
    return settle(groups.join(fit_outliers(rows), "_group").drop("_group"), "mcd-keys")


def _verdicts(stats: DataFrame, estimates: DataFrame) -> DataFrame:
    keys = ["_no_lang", "_lang", "_no_source", "_source"]
    if estimates.count() <= MAX_BROADCAST_GROUPS:
        estimates = F.broadcast(estimates)
    far = _distance(vector(F.col("_s"))) > CUTOFF
    joined = stats.join(estimates, keys, "left")
    return joined.withColumn("_kept", ~base_failed(F.col("_s")) & ~F.coalesce(far, F.lit(False)))


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """The counts of every document, whether it fails the base rules, and whether it is kept.

    A document is kept if it passes the base rules and its vector of transformed counts is no
    robust outlier among the documents of its language and source.

    Null or empty text: no words, so the base rules fail. Null language or source: a value of its own.
    Groups under 60 rows are pooled by language, then altogether; what is still too few is judged
    all the same (the floors hold). Repeated rows count each time. Empty table: no rows. Very long
    texts take time in proportion to their words (times the logarithm where windows repeat). Other columns are not read.
    """
    stats = settle(_narrow(docs, "doc_id"), "quality-counts")
    judged = _verdicts(stats, _estimates(stats))
    return judged.select(
        "doc_id",
        *[f"_s.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed(F.col("_s")).alias("base_failed"),
        F.col("_kept").alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that ``quality_verdicts`` keeps, as they came.

    Texts are read twice (once for the estimates, once for the verdicts) rather than moved.
    """
    estimates = _estimates(settle(_narrow(docs), "quality-counts"))
    taken = docs.select(F.struct("*").alias("_doc")).select(
        "_doc",
        text_statistics(F.col("_doc.text")).alias("_s"),
        *[c.alias(k) for k, c in _keyed(F.col("_doc.lang"), F.col("_doc.source")).items()],
    )
    return _verdicts(taken, estimates).where("_kept").select("_doc.*")
