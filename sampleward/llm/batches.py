"""Arrow batches between Spark and the operators' Python code."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Rows a task gives back in one Arrow batch.
ROWS = 1024


def texts(docs: DataFrame, text: str = "text", others: Iterable[str] = ()) -> DataFrame:
    """doc_id, text and the named columns alone, a null text as the empty one; other columns are not read."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        *others,
    )


def rows_of(batches: Iterator[pa.RecordBatch], size: int = 64) -> Iterator[tuple]:
    """The rows of the batches, turned into Python values a few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            part = batch.slice(start, size)
            yield from zip(*(column.to_pylist() for column in part.columns))


def map_rows(
    df: DataFrame, function: Callable[[Iterator[tuple]], Iterable[tuple]], schema: str, size: int = ROWS
) -> DataFrame:
    """mapInArrow for a function from rows to rows, one call per task; `size` rows go back at once."""
    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        waiting: list[tuple] = []
        for row in function(rows_of(batches)):
            waiting.append(row)
            if len(waiting) == size:
                yield batch(waiting)
                waiting = []
        if waiting:
            yield batch(waiting)

    return df.mapInArrow(run, struct)
