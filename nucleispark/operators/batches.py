"""Groups of rows for Python: dealt to tasks, and sorted ones in batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def deal(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows with groups spread over enough tasks. Groups hold few bytes, but take much work: by size alone Spark would put
    too many of them into one task."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), *keys)


def begins(pdf: pd.DataFrame, names: list[str]) -> np.ndarray:
    """Where each run of rows with equal names begins; nulls are equal."""
    new = np.zeros(max(len(pdf) - 1, 0), bool)
    for column in (pdf[n] for n in names):
        values, null = column.to_numpy(), column.isna().to_numpy()
        new |= (values[1:] != values[:-1]) & ~(null[1:] & null[:-1])
    return np.flatnonzero(np.append(True, new)[: len(pdf)])


def whole_groups(names: list[str], function: Callable[[pd.DataFrame], pd.DataFrame], rows: int = 20_000) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For mapInPandas over rows dealt and sorted by `names`: calls `function` with runs of whole groups, of `rows` rows or more together
    while there are any: a call for each batch would take longer than its work."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        n, wanted = 0, rows
        for pdf in batches:
            if not len(pdf):
                continue
            held.append(pdf)
            n += len(pdf)
            if n >= wanted:
                whole = pd.concat(held, ignore_index=True)
                last = int(begins(whole, names)[-1])  # the last group so far, which may go on in the next batches
                if last:
                    yield function(whole.iloc[:last])
                held, n = [whole.iloc[last:]], len(whole) - last
                wanted = max(rows, 2 * n)
        if held:
            yield function(pd.concat(held, ignore_index=True))

    return run


def table_begins(table: pa.Table, names: list[str]) -> np.ndarray:
    """begins for a table."""
    n = table.num_rows
    same = np.ones(max(n - 1, 0), bool)
    for v in (table.column(c) for c in names):
        a, b = v.slice(1), v.slice(0, max(n - 1, 0))
        same &= pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b))).to_numpy()
    return np.flatnonzero(np.append(True, ~same)[:n])


def whole_tables(names: list[str], function: Callable[[pa.Table], Iterator[pa.RecordBatch]], rows: int = 20_000) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """whole_groups for mapInArrow: `function` gets tables of one chunk, and may give many batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, wanted = 0, rows
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n >= wanted:
                whole = pa.Table.from_batches(held).combine_chunks()
                last = int(table_begins(whole, names)[-1])
                if last:
                    yield from function(whole.slice(0, last))
                held, n = whole.slice(last).to_batches(), n - last
                wanted = max(rows, 2 * n)
        if held:
            yield from function(pa.Table.from_batches(held).combine_chunks())

    return run
