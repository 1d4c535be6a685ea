"""Staged data in the folder that all executors share, and small tables made on the driver."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="sampleward-")


def shared_folder(spark: SparkSession) -> str:
    """Folder named by `spark.checkpoint.dir`; a temporary one only in local mode, where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or _own_folder()).rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the rows once and read them back, so that later passes all see the same ones."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """Rows made on the driver, such as one per governed table.

    They come in as Arrow, so Spark knows their size and decides by it whether to broadcast them.
    """
    columns = list(zip(*rows)) or [()] * len(schema)
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)
