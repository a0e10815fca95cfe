"""Slide tables derived from the driver's tables, in one text that Spark SQL and DuckDB both run.

`{name}` stands for a driver table. Spark fills in a DataFrame, DuckDB the view of that name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nucleispark.session import read

DETECTIONS = """
SELECT slide_id,
  row_number() OVER (PARTITION BY slide_id ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate) AS nucleus_id,
  xc - bw / 2.0E0 AS x0, yc - bh / 2.0E0 AS y0, xc + bw / 2.0E0 AS x1, yc + bh / 2.0E0 AS y1,
  CASE WHEN l_linenumber = 7 THEN -100 WHEN l_linenumber = 6 AND l_linestatus = 'O' THEN 0 WHEN l_returnflag = 'A' THEN 1
       WHEN l_returnflag = 'N' THEN 2 WHEN l_linestatus = 'F' THEN 3 ELSE 4 END AS label,
  0.15E0 + 8.5E0 * l_discount AS score
FROM (
  SELECT *, CAST(floor(l_suppkey / 12) AS BIGINT) AS slide_id,
    (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 4096 AS xc,
    (l_partkey * 6007 + l_orderkey * 3571 + l_suppkey * 97) % 4096 AS yc,
    CAST(8 + l_quantity AS BIGINT) AS bw, 8 + CAST(floor(l_extendedprice) AS BIGINT) % 43 AS bh
  FROM {lineitem}
) AS raw
"""

SLIDES = """
SELECT slide_id, 4096 AS h, 4096 AS w,
  CASE WHEN slide_id % 3 = 1 THEN 0.5E0 ELSE 0.25E0 END AS mpp,
  CASE WHEN slide_id % 3 = 1 THEN 20.0E0 ELSE 40.0E0 END AS magnitude,
  CASE WHEN slide_id % 3 = 1 THEN 'Scan Image|AppMag = 20|MPP = 0.5' ELSE 'Scan Image|AppMag = 40|MPP = 0.25' END AS description,
  slide_id % 3 AS patient_id
FROM (SELECT DISTINCT CAST(floor(s_suppkey / 12) AS BIGINT) AS slide_id FROM {supplier}) AS ids
"""

REQUESTS = """
SELECT event_id, ts, CAST(user_id % 9 AS BIGINT) AS slide_id, CAST((event_id * 7) % 8 AS BIGINT) AS tile_col,
  CAST((event_id * 3 + user_id) % 8 AS BIGINT) AS tile_row
FROM {events}
"""

#: One 8 x 8 raster for each vector: value v, mask, and `level`, 0 to 64.
PIXELS = {
    "spark": "SELECT vec_id, label, pos DIV 8 AS y, pos % 8 AS x, CAST(v AS DOUBLE) AS v FROM (SELECT vec_id, label, posexplode(embedding) AS (pos, v) FROM {embeddings}) AS raw",
    "duckdb": "SELECT vec_id, label, CAST(i // 8 AS INT) AS y, CAST(i % 8 AS INT) AS x, CAST(embedding[i + 1] AS DOUBLE) AS v FROM {embeddings}, range(64) AS r(i)",
}

_TEXTS = {"detections": (DETECTIONS, "lineitem"), "slides": (SLIDES, "supplier"), "requests": (REQUESTS, "events"), "pixels": (PIXELS, "embeddings")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, source = _TEXTS[name]
    return spark.sql(text if isinstance(text, str) else text["spark"], **{source: read(spark, sf_dir, source)})


def tables(spark: SparkSession, sf_dir: str, *names: str) -> tuple[DataFrame, ...]:
    return tuple(table(spark, sf_dir, n) for n in names)


def with_tables(sql: str, *names: str) -> str:
    """DuckDB SQL with those derived tables as common table expressions before its own."""
    texts = []
    for n in names:
        text, source = _TEXTS[n]
        texts.append(f"{n} AS ({(text if isinstance(text, str) else text['duckdb']).format(**{source: source})})")
    sql = sql.strip()
    return f"WITH {'RECURSIVE ' if sql.upper().startswith('WITH RECURSIVE') else ''}" + ", ".join(texts) + (", " + sql.split(None, 2 if sql.upper().startswith("WITH RECURSIVE") else 1)[-1] if sql.upper().startswith("WITH") else " " + sql)
