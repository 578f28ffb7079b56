"""Columns out of JSON text by path, with one parse per row however many paths there are."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _tree(paths: Mapping[str, tuple[str, str]]) -> dict:
    tree: dict = {}
    for path, kind in paths.values():
        *parents, leaf = path.removeprefix("$.").split(".")
        node = tree
        for name in parents:
            node = node.setdefault(name, {})
            if not isinstance(node, dict):
                raise ValueError(f"{path}: {name} is also read as {node}")
        if node.setdefault(leaf, kind) != kind:
            raise ValueError(f"{path} is read as two types")
    return tree


def _ddl(tree: dict) -> str:
    parts = [f"`{k}` {v if isinstance(v, str) else 'struct<' + _nested(v) + '>'}" for k, v in tree.items()]
    return ", ".join(parts)


def _nested(tree: dict) -> str:
    parts = [f"`{k}`: {v if isinstance(v, str) else 'struct<' + _nested(v) + '>'}" for k, v in tree.items()]
    return ", ".join(parts)


def extract_paths(
    df: DataFrame, value: Column | str, paths: Mapping[str, tuple[str, str]], *keep: str
) -> DataFrame:
    """``paths`` maps output names to (path such as ``$.after.id``, type)."""
    value = F.col(value) if isinstance(value, str) else value
    parsed = df.withColumn("_json", F.from_json(value, _ddl(_tree(paths))))
    found = [F.col(f"_json.{path.removeprefix('$.')}").alias(out) for out, (path, _) in paths.items()]
    return parsed.select(*keep, *found)


def iso_to_millis(text: Column) -> Column:
    """Epoch milliseconds of ISO text with a zone; null if it is not a time."""
    return F.unix_millis(text.try_cast("timestamp"))
