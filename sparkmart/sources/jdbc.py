"""Relational sinks: staged upsert and replace-all over JDBC.

Rows are written by the executors to a staging table; the last step is one statement that the
database runs in a transaction.  Any driver on the session's classpath can be used.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from sparkmart.operators.keyed import latest_per_key

BATCH_ROWS = 2000


def cast_columns(columns: Sequence[str], casts: Mapping[str, str]) -> list[str]:
    """Select items in which columns named in ``casts`` are cast to the sink's types."""
    return [f'CAST("{c}" AS {casts[c]})' if c in casts else f'"{c}"' for c in columns]


def merge_statement(
    table: str, staging: str, columns: Sequence[str], key: Sequence[str], casts: Mapping[str, str]
) -> str:
    """Standard MERGE of a staging table into the target by key."""
    match = " AND ".join(f't."{k}" = s."{k}"' for k in key)
    updates = ", ".join(f't."{c}" = s."{c}"' for c in columns if c not in key)
    names = ", ".join(f'"{c}"' for c in columns)
    values = ", ".join(f's."{c}"' for c in columns)
    named = ", ".join(f'{item} AS "{c}"' for c, item in zip(columns, cast_columns(columns, casts)))
    matched = f" WHEN MATCHED THEN UPDATE SET {updates}" if updates else ""
    return (
        f"MERGE INTO {table} t USING (SELECT {named} FROM {staging}) s ON {match}{matched} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def on_conflict_statement(
    table: str, staging: str, columns: Sequence[str], key: Sequence[str], casts: Mapping[str, str]
) -> str:
    """The same upsert for databases that have INSERT … ON CONFLICT."""
    names = ", ".join(f'"{c}"' for c in columns)
    keys = ", ".join(f'"{k}"' for k in key)
    updates = ", ".join(f'"{c}" = EXCLUDED."{c}"' for c in columns if c not in key)
    action = f"DO UPDATE SET {updates}" if updates else "DO NOTHING"
    return (
        f"INSERT INTO {table} ({names}) SELECT {', '.join(cast_columns(columns, casts))} FROM {staging} "
        f"ON CONFLICT ({keys}) {action}"
    )


def replace_statements(
    table: str, staging: str, columns: Sequence[str], casts: Mapping[str, str]
) -> list[str]:
    """Empty and refill the target from staging, for one transaction."""
    names = ", ".join(f'"{c}"' for c in columns)
    return [
        f"DELETE FROM {table}",
        f"INSERT INTO {table} ({names}) SELECT {', '.join(cast_columns(columns, casts))} FROM {staging}",
    ]


def stage(df: DataFrame, url: str, staging: str, props: Mapping[str, str], partitions: int) -> None:
    """Write rows to the staging table over ``partitions`` connections.

    The exchange keeps the work before it parallel; only the connections are few.
    """
    (
        df.repartition(partitions)
        .write.format("jdbc")
        .options(**props)
        .option("url", url)
        .option("dbtable", staging)
        .option("batchsize", BATCH_ROWS)
        .option("truncate", "true")
        .mode("overwrite")
        .save()
    )


@contextmanager
def _staged(df: DataFrame, url: str, table: str, props: Mapping[str, str], partitions: int):
    """A staging table of this run's own, dropped whatever happens."""
    staging = staging_name(table)
    try:
        stage(df, url, staging, props, partitions)
        yield staging
    finally:
        _execute(df.sparkSession, url, props, [f"DROP TABLE IF EXISTS {staging}"])


def staging_name(table: str) -> str:
    """A name that no other run uses."""
    return f"{table}_staging_{uuid.uuid4().hex[:12]}"


@contextmanager
def _transaction(spark: SparkSession, url: str, props: Mapping[str, str]):
    jvm_props = spark._jvm.java.util.Properties()
    for k, v in props.items():
        jvm_props.setProperty(k, v)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, jvm_props)
    try:
        connection.setAutoCommit(False)
        yield connection
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _execute(spark: SparkSession, url: str, props: Mapping[str, str], statements: Sequence[str]):
    with _transaction(spark, url, props) as connection:
        for sql in statements:
            statement = connection.createStatement()
            try:
                statement.execute(sql)
            finally:
                statement.close()


def upsert(
    df: DataFrame,
    url: str,
    table: str,
    key: Sequence[str],
    props: Mapping[str, str],
    casts: Mapping[str, str] | None = None,
    time: str = "event_time",
    dialect: str = "merge",
    partitions: int = 4,
) -> None:
    """Deduplicate on the key, stage, then upsert in one statement; faults are raised."""
    spark = df.sparkSession
    rows = latest_per_key(df, key, (time,))
    build = {"merge": merge_statement, "on_conflict": on_conflict_statement}[dialect]
    with _staged(rows, url, table, props, partitions) as staging:
        _execute(spark, url, props, [build(table, staging, rows.columns, key, casts or {})])


def replace(
    df: DataFrame,
    url: str,
    table: str,
    props: Mapping[str, str],
    casts: Mapping[str, str] | None = None,
    partitions: int = 4,
) -> None:
    """Replace all rows of the target in one transaction."""
    with _staged(df, url, table, props, partitions) as staging:
        _execute(df.sparkSession, url, props, replace_statements(table, staging, df.columns, casts or {}))
