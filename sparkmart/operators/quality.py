"""Table-level checks driven by the declared specs.

Each rule takes one pass over typed values. Counts of references and of keys are summed before the exchange, so a
parent with a third of all references, or a key with a third of all rows, is one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.keyed import duplicate_keys
from sparkmart.operators.skew import key_counts, tasks_for_keys
from sparkmart.specs import TABLES, TableSpec


def _need(df: DataFrame, columns: tuple[str, ...], table: str) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"table {table} has no column {', '.join(absent)}, which a rule names")


def _missing_parents(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], keep: bool):
    """For each reference its rule and the rows that refer to no parent, or with ``keep`` off their keys counted."""
    parents: dict[str, int] = {}  # tasks that the keys of a referenced table need
    for name, child in tables.items():
        for ref in specs[name].references:
            if ref.target not in tables:
                continue
            key = specs[name].key[0]
            _need(child, (key, ref.column) if keep else (ref.column,), name)
            rule = {"table_name": name, "column_name": ref.column, "target": ref.target}
            used = child.select(F.col(ref.column).alias("_key"), *([F.col(key).alias("_id")] if keep else []))
            used = used.filter(F.col("_key").isNotNull())
            known = tables[ref.target].select(F.col(specs[ref.target].key[0]).alias("_key"))
            if not keep:
                # both sides dealt out to tasks of a bounded number of keys, whichever has more of them
                if ref.target not in parents:
                    parents[ref.target] = tasks_for_keys(known, ["_key"])
                needed = tasks_for_keys(used, ["_key"])
                wanted = max(parents[ref.target], needed)
                used = key_counts(used, ["_key"], "_rows", needed, wanted)
                known = known.repartition(wanted, "_key") if wanted else known
            missing = used.join(known, "_key", "left_anti")
            yield missing.select(*[F.lit(v).alias(k) for k, v in rule.items()], *[c for c in missing.columns if keep or c != "_key"])


def reference_violations(
    tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec] = TABLES
) -> DataFrame:
    """Rows that refer to a missing parent: (table, column, target, id, missing key), keys compared in their own types.

    References to tables that are not given are not checked; an absent column is an error.
    """
    found = [
        rows.select(
            "table_name", "column_name", "target", F.col("_id").cast("string").alias("row_id"),
            F.col("_key").cast("string").alias("missing_key"),
        )
        for rows in _missing_parents(tables, specs, keep=True)
    ]
    return reduce(DataFrame.unionByName, found)


def reference_violation_counts(
    tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec] = TABLES
) -> DataFrame:
    """Violations and distinct missing keys per reference that has any; counted by key before they are joined."""
    found = reduce(DataFrame.unionByName, _missing_parents(tables, specs, keep=False))
    return found.groupBy("table_name", "column_name", "target").agg(
        F.sum("_rows").alias("violations"), F.count(F.lit(1)).alias("missing_keys")
    )


def key_violations(tables: Mapping[str, DataFrame], specs: Mapping = TABLES) -> DataFrame:
    """Duplicate primary and unique keys of every table or mart, as (table, key, value, copies).

    Each rule counts its keys in their own types, summed before the exchange, so a key with a third of the rows is one row per
    task; only keys that repeat become text. Keys with a null are outside a uniqueness rule.
    """
    found = []
    for name, df in tables.items():
        for rule in (specs[name].key, *getattr(specs[name], "unique", ())):
            _need(df, rule, name)
            text = F.array_join(F.array(*[F.col(k).cast("string") for k in rule]), ",")
            labels = [F.lit(name).alias("table_name"), F.lit(",".join(rule)).alias("key_columns")]
            found.append(duplicate_keys(df, rule).select(*labels, text.alias("key_value"), "copies"))
    return reduce(DataFrame.unionByName, found)
