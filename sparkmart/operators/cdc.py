"""Change capture: decode envelopes, apply changes, audit and diff."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.operators.keyed import latest_per_key

# Operation codes of a change event.
SNAPSHOT, CREATE, UPDATE, DELETE = "r", "c", "u", "d"
UPSERTS = (CREATE, UPDATE, SNAPSHOT)

_CORRUPT = "_corrupt"

# Text form of times in written events (reading accepts any ISO fraction).
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def envelope_schema(row: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
            T.StructField("seq", T.LongType()),
        ]
    )


def _parse_schema(row: T.StructType) -> T.StructType:
    """The envelope as it comes: with the log position in ``source`` and a mark for what does not parse."""
    source = T.StructType([T.StructField("lsn", T.LongType())])
    return T.StructType(
        [*envelope_schema(row).fields, T.StructField("source", source), T.StructField(_CORRUPT, T.StringType())]
    )


def has_image(key: Sequence[str] = (), at: str = "") -> Column:
    """Whether an event holds the image it is about, with its key: ``before`` of a delete, else ``after``.

    An update without an ``after`` image says nothing about the row; taken for one, it would make all columns null.
    """

    def there(image: str) -> Column:
        present = F.col(f"{at}{image}").isNotNull()
        for k in key:
            present = present & F.col(f"{at}{image}")[k].isNotNull()
        return present

    return F.when(F.col(f"{at}op") == DELETE, there("before")).otherwise(there("after"))


def decode(
    raw: DataFrame, row: T.StructType, value: str = "value", key: Sequence[str] = (), seen: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """(change events, undecodable lines) from JSON text; each reads a line with one parse.

    ``seen`` counts the lines as ``rows`` and the undecodable ones as ``bad`` while the events are read, so that nobody parses all lines again for none.

    Undecodable are malformed lines, lines with a field that does not parse as its declared type (it would
    else become null and overwrite a good value), unknown operations and events without the image they are
    about or, with ``key``, without its key (see ``has_image``). ``seq`` orders events of equal time: the envelope's own, else the log position in
    ``source.lsn``, else the ``offset`` of the record where the reader kept it.
    """
    # always true, but not to the optimizer, which would copy the parse into the filters above, once for each field they read
    text = F.when(F.spark_partition_id() >= 0, F.col(value).cast("string"))
    parsed = raw.withColumn("_e", F.from_json(text, _parse_schema(row), {"columnNameOfCorruptRecord": _CORRUPT}))
    readable = F.col(f"_e.{_CORRUPT}").isNull() & F.coalesce(F.col("_e.op").isin(*UPSERTS, DELETE), F.lit(False))
    readable = readable & has_image(key, "_e.")
    position = [F.col("_e.seq"), F.col("_e.source.lsn")] + ([F.col("offset")] if "offset" in raw.columns else [])
    told = parsed if seen is None else parsed.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(~readable).alias("bad"))
    events = told.filter(readable).select(
        "_e.before", "_e.after", "_e.op", "_e.ts_ms", F.coalesce(*position).alias("seq")
    )
    quarantine = parsed.filter(~readable).select(F.col(value).cast("string").alias("value"))
    return events, quarantine


def keep_ops(events: DataFrame, ops: Sequence[str] = UPSERTS) -> DataFrame:
    return events.filter(F.col("op").isin(*ops))


def row_image(image_key: Sequence[str]) -> list[Column]:
    """Key columns of an event: from ``before`` when it is a delete, else from ``after``."""
    gone = F.col("op") == DELETE
    return [F.when(gone, F.col("before")[k]).otherwise(F.col("after")[k]).alias(k) for k in image_key]


def changes(events: DataFrame, key: Sequence[str]) -> DataFrame:
    """Flat change rows: key, the remaining columns, and ``_op``, ``_ts``, ``_seq``.

    Events of unknown kind and those without their image or key are left out; ``_seq`` orders events of equal time.
    """
    row = events.schema["after"].dataType
    rest = [F.col("after")[f.name].alias(f.name) for f in row.fields if f.name not in key]
    known = events.filter(F.col("op").isin(*UPSERTS, DELETE) & has_image(key))
    return known.select(
        *row_image(key),
        *rest,
        F.col("op").alias("_op"),
        F.col("ts_ms").alias("_ts"),
        F.coalesce(F.col("seq"), F.lit(0).cast("long")).alias("_seq"),
    )


def reduce_changes(flat: DataFrame, key: Sequence[str]) -> DataFrame:
    """The last change of every key (map-side reduced; see ``latest_per_key``)."""
    return latest_per_key(flat, key, order=("_ts", "_seq"))


def apply_changes(events: DataFrame, key: Sequence[str], deletes: str = "apply") -> DataFrame:
    """Current table from a change log: last change per key, deleted keys removed.

    ``deletes="ignore"`` skips delete events, so a key keeps its last inserted row.
    """
    if deletes not in ("apply", "ignore"):
        raise ValueError(f"deletes must be 'apply' or 'ignore', not {deletes!r}")
    flat = changes(events, key)
    if deletes == "ignore":
        flat = flat.filter(F.col("_op") != DELETE)
    last = reduce_changes(flat, key)
    return last.filter(F.col("_op") != DELETE).drop("_op", "_ts", "_seq")


def changed_columns(events: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per (key, column) whose value differs between the before and after image."""
    row = events.schema["after"].dataType
    entries = []
    for f in row.fields:
        if f.name in key:
            continue
        old, new = F.col("before")[f.name], F.col("after")[f.name]
        entry = F.struct(
            F.lit(f.name).alias("column_name"),
            old.cast("string").alias("old_value"),
            new.cast("string").alias("new_value"),
        )
        entries.append(F.when(~old.eqNullSafe(new), entry))
    # the images are taken apart before the generator: above it, Spark loses one of them if ``op`` is a constant
    audited = events.filter(F.col("op") == UPDATE).select(
        *row_image(key), "ts_ms", F.array_compact(F.array(*entries)).alias("_d")
    )
    return audited.select(*key, "ts_ms", F.explode("_d").alias("_d")).select(*key, "ts_ms", "_d.*")


def snapshot_diff(before: DataFrame | None, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Change events that turn one snapshot into the next; ``before=None`` is a first snapshot."""
    images = list(after.columns)
    if before is None:
        image = F.struct(*images)
        return after.select(
            *key, F.lit(SNAPSHOT).alias("op"), F.lit(None).cast(_struct_of(after)).alias("before"),
            image.alias("after"),
        )
    b = before.select(*[F.col(k).alias(f"_b_{k}") for k in key], F.struct(*images).alias("before"))
    a = after.select(*[F.col(k).alias(f"_a_{k}") for k in key], F.struct(*images).alias("after"))
    same_key = None
    for k in key:
        eq = F.col(f"_b_{k}") == F.col(f"_a_{k}")
        same_key = eq if same_key is None else same_key & eq
    joined = b.join(a, same_key, "full_outer")
    op = (
        F.when(F.col("before").isNull(), F.lit(CREATE))
        .when(F.col("after").isNull(), F.lit(DELETE))
        .when(~F.col("before").eqNullSafe(F.col("after")), F.lit(UPDATE))
    )
    keys = [F.coalesce(F.col(f"_a_{k}"), F.col(f"_b_{k}")).alias(k) for k in key]
    return joined.select(*keys, op.alias("op"), "before", "after").filter(F.col("op").isNotNull())


def _struct_of(df: DataFrame) -> T.StructType:
    return T.StructType(df.schema.fields)


def to_envelope(
    after: Column | None, before: Column | None, op: Column, ts_ms: Column, seq: Column
) -> Column:
    """JSON text of a change event, in the source's shapes."""
    parts = []
    if before is not None:
        parts.append(before.alias("before"))
    if after is not None:
        parts.append(after.alias("after"))
    parts += [op.alias("op"), ts_ms.alias("ts_ms"), seq.alias("seq")]
    return F.to_json(F.struct(*parts), TIME_FORMATS)
