"""Runs queries of the entry file beside their DuckDB counterparts: `python tests/compare.py [--sf sf0.01] [NAME part ...]`."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = "/root/testdata"


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.9g}"
    if isinstance(x, list | tuple):
        return str([plain(y) for y in x])
    return str(x)


def normal(rows, names: list[str]) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def from_duckdb(sql: str, folder: str) -> list[tuple[str, ...]]:
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for name in sorted(os.listdir(folder)):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{folder}/{name}'")
    found = con.sql(sql)
    return normal(found.fetchall(), found.columns)


def differences(df, sql: str, folder: str) -> str:
    """Empty if both give the same rows and column names."""
    con = duckdb.connect()
    for name in sorted(os.listdir(folder)):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{folder}/{name}'")
    found = con.sql(sql)
    if sorted(found.columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(found.columns)}"
    a, b = normal(df.collect(), df.columns), normal(found.fetchall(), found.columns)
    if a == b:
        return ""
    in_a, in_b = set(a), set(b)
    more, less = [x for x in a if x not in in_b][:3], [x for x in b if x not in in_a][:3]
    return f"{len(a)} and {len(b)} rows; only Spark: {more}; only DuckDB: {less}"


def main(args: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = args[args.index("--sf") + 1] if "--sf" in args else "sf0.01"
    parts = [a for a in args if a not in ("--sf", sf)]
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    bad = 0
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        began = time.time()
        try:
            df = run(spark, f"{DATA}/{sf}")
            if name in oracles:
                said = differences(df, oracles[name], f"{DATA}/{sf}") or "same"
            else:
                said = f"{df.count()} rows, no oracle"
        except Exception as e:  # noqa: BLE001
            said = "error " + str(e)[:700]
        bad += said not in ("same",) and not said.endswith("no oracle")
        print(f"{name}: {said[:1500]} ({time.time() - began:.1f} s)", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
