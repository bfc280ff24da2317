"""Run registered queries in Spark and DuckDB and compare all rows.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb
import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession

from checks import registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def text(v) -> str:
    if v is None or (isinstance(v, float) and v != v):
        return "NULL"
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, list):
        return str([text(x) for x in v])
    return str(v)


def normal(table: pa.Table) -> pd.DataFrame:
    """Rows as text, columns and rows sorted, so that only values matter."""
    names = sorted(table.column_names)
    out = pd.DataFrame({c: [text(v) for v in table[c].to_pylist()] for c in names})
    return out.sort_values(names).reset_index(drop=True)


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str:
    started = time.time()
    got = registry.queries()[name](spark, sf_dir).toArrow()
    spark_time = time.time() - started
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return f"rows-only {got.num_rows} rows, spark {spark_time:.1f}s"
    started = time.time()
    want = con.sql(sql).to_arrow_table()
    duck_time = time.time() - started
    note = f"{got.num_rows} rows, spark {spark_time:.1f}s, duckdb {duck_time:.1f}s"
    kinds = {c: (str(got.schema.field(c).type), str(want.schema.field(c).type))
             for c in got.column_names if c in want.column_names}
    odd = {c: k for c, k in kinds.items() if k[0] != k[1]}
    if odd:
        note += f", types differ {odd}"
    if sorted(got.column_names) != sorted(want.column_names):
        return f"FAIL columns {sorted(set(got.column_names) ^ set(want.column_names))} {note}"
    if got.num_rows != want.num_rows:
        return f"FAIL rows {got.num_rows} vs {want.num_rows} {note}"
    a, b = normal(got), normal(want)
    if a.equals(b):
        return f"ok {note}"
    out = [f"FAIL values {note}"]
    for c in a.columns:
        x, y = Counter(a[c]), Counter(b[c])
        if x != y:
            out.append(f"  {c}: spark {list((x - y).items())[:4]} duckdb {list((y - x).items())[:4]}")
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        try:
            result = compare(spark, con, sf_dir, name)
        except Exception as exc:  # report and go on with the next query
            result = f"ERROR {type(exc).__name__}: {str(exc)[:1500]}"
        failed += not result.startswith(("ok", "rows-only"))
        print(f"{name}: {result}", flush=True)
    print(f"{failed} failed of {len(names)} ({Path(sf_dir).name})")
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
