"""URL filter: rules by host and path, and an empirical-Bayes reputation of hosts for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.session import settle

# Fixed values of the contract: host/path and what the rule says.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
# Suffixes of two labels under which names are registered (public knowledge, not complete; a parameter).
TWO_LABEL_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "net.au", "org.au", "org.uk")

MIN_GOOD = 0.35  # a page is let through if its host's share of good pages is this at least ...
Z = 1.0  # ... even this many posterior standard deviations below the mean
PRIOR_MEAN, PRIOR_STRENGTH = 0.75, 4.0  # where nothing at all is labelled
STRENGTHS = (1.0, 1000.0)  # bounds of a fitted prior strength


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Add ``rule`` and ``_ruled``: the longest rule whose host and path start fit, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):  # the longest is tested first
        name, slash, rest = text.partition("/")
        own = (F.col("host") == name) | F.col("host").endswith("." + name)
        fits = own & F.col("path").startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return pages.withColumns({"rule": rule, "_ruled": verdict})


def host_levels(host: Column, two_label: Sequence[str] = TWO_LABEL_SUFFIXES) -> dict[str, Column]:
    """``_domain`` (registered domain) and ``_suffix`` of a host; the port is not part of either."""
    labels = F.split(F.regexp_replace(host, r":[0-9]*$", ""), r"\.", -1)
    last_two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    suffix_labels = F.when(last_two.isin(*two_label), 2).otherwise(1)
    tail = lambda n: F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), ".")
    return {"_suffix": tail(suffix_labels), "_domain": tail(suffix_labels + 1)}


def _posterior(level: DataFrame, key: str, parent: str | None) -> DataFrame:
    """Beta posterior of each ``key`` from its counts and its parent's mean (``_mean``).

    The prior's strength is fitted once per level by moments: the counts' spread around the parents'
    means, beyond what binomial noise explains, says how alike children of one parent are.
    """
    share, p = F.col("good") / F.col("n"), F.col("_mean")
    counted = level.where("n > 0")
    # E[(share - p)^2] = p (1 - p) (rho + (1 - rho) / n); strength = 1 / rho - 1
    spread = counted.agg(
        F.sum(F.col("n") * (share - p) ** 2).alias("seen"),
        F.sum(p * (1 - p)).alias("noise"),
        F.sum(F.col("n") * p * (1 - p)).alias("scale"),
    )
    rho = (F.col("seen") - F.col("noise")) / (F.col("scale") - F.col("noise"))
    fitted = F.greatest(F.lit(STRENGTHS[0]), F.least(F.lit(STRENGTHS[1]), 1 / F.greatest(rho, F.lit(1e-6)) - 1))
    strength = spread.select(
        F.coalesce(F.when(F.col("scale") > F.col("noise"), fitted), F.lit(PRIOR_STRENGTH)).alias("strength")
    )
    a, b = F.col("good") + F.col("_s") * p, F.col("n") - F.col("good") + F.col("_s") * (1 - p)
    return level.withColumn("_s", strength.scalar()).select(
        key,
        *([parent] if parent else []),
        "good",
        "n",
        (a / (a + b)).alias("_post"),
        F.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))).alias("_sd"),
    )


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior mean and deviation of the share of good pages, one row per host.

    ``outcomes`` has a row per page with ``host`` and ``good`` (1, 0, or null where the outcome is
    not known). Counts go up from host to registered domain to suffix by aggregates; means come
    down again as prior means: all hosts -> suffix -> domain -> host. A host without labels has its
    domain's mean and a wide deviation. A hot host costs one row per task, as the counts are summed
    before the exchange; no level's rows are gathered.
    """
    hosts = outcomes.groupBy("host").agg(
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.count("good").alias("n")
    )
    # one row per host, read by every level below
    hosts = settle(hosts.withColumns(host_levels(F.col("host"))), "host-counts")
    up = [F.sum("good").alias("good"), F.sum("n").alias("n")]
    domains = hosts.groupBy("_suffix", "_domain").agg(*up)
    suffixes = domains.groupBy("_suffix").agg(*up)
    s = PRIOR_STRENGTH
    root = suffixes.agg(
        ((F.coalesce(F.sum("good"), F.lit(0)) + s * PRIOR_MEAN) / (F.coalesce(F.sum("n"), F.lit(0)) + s))
    )
    by_suffix = _posterior(suffixes.withColumn("_mean", root.scalar()), "_suffix", None)
    mean_of = lambda rows, key: rows.select(key, F.col("_post").alias("_mean"))
    by_domain = _posterior(domains.join(mean_of(by_suffix, "_suffix"), "_suffix"), "_domain", "_suffix")
    return _posterior(hosts.join(mean_of(by_domain, "_domain"), "_domain"), "host", "_domain").select(
        "host", "good", "n", F.col("_post").alias("mean"), F.col("_sd").alias("sd")
    )


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, min_good: float = MIN_GOOD, z: float = Z
) -> DataFrame:
    """Allow or block every page: by its longest rule, else by the reputation of its host.

    Pages that a rule fits are the labelled outcomes. A page without one is allowed if the
    lower bound of its host's posterior (mean less ``z`` deviations) is at least ``min_good``.

    Null url, or one without ``://``: empty host and path, judged like a host of its own. Repeated
    pages count each time. Without any rule that fits, all hosts have the prior. Empty table: no
    rows. Other columns are not read.
    """
    parsed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    ruled = rule_verdicts(parsed, rules)
    good = F.when(F.col("_ruled") == "allow", 1).when(F.col("_ruled") == "block", 0)
    reputation = host_reputation(ruled.select("host", good.cast("long").alias("good")))
    trusted = reputation.select("host", (F.col("mean") - z * F.col("sd") >= min_good).alias("_trusted"))
    by_method = F.when(F.col("_trusted"), "allow").otherwise("block")
    return ruled.join(trusted, "host").select(
        "page_id", "host", "path", "rule", F.coalesce(F.col("_ruled"), by_method).alias("verdict")
    )
