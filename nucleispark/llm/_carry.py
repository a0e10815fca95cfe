"""Passing texts through an array function with other columns carried along."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_column(rows: DataFrame, column: str, keep: Sequence[str], new: str, function: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """Kept columns and the `new` ones (DDL), which `function` makes from a batch of `column`: as many arrays, as long.

    Kept columns may have any names, also those of new ones; they come first, in order, and go by their place.
    """
    inner = rows.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)), F.col(f"`{column}`").alias("x"))
    added = T._parse_datatype_string(new)
    schema = T.StructType([*inner.schema.fields[:-1], *(T.StructField(f"n{i}", f.dataType) for i, f in enumerate(added.fields))])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *function(batch.columns[-1])], names=names)

    return inner.mapInArrow(run, schema).toDF(*keep, *added.names)
