"""Run registered queries against DuckDB: python check_oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, "tests")
from oracle import compare, connect  # noqa: E402

from sparkmart.workload import REGISTRY  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        q, started = REGISTRY[name], time.time()
        try:
            df = q(spark, sf_dir)
            fault = compare(df, con, q.sql) if q.sql else f"no oracle, {df.count()} rows"
            rows = "" if fault else f"{con.execute(f'SELECT COUNT(*) FROM ({q.sql})').fetchone()[0]} rows"
        except Exception as error:  # report and go on with the next query
            fault, rows = f"{type(error).__name__}: {str(error)[:600]}", ""
        good = fault is None or fault.startswith("no oracle")
        bad += not good
        print(f"{'ok  ' if good else 'FAIL'} {name:36s} {time.time() - started:6.2f}s {rows}{fault or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
