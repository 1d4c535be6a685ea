"""Column layouts of the small tables that a cycle works with."""

from pyspark.sql import types as T

TABLE_KEY = ["project_id", "dataset_id", "table_id"]

CONFIG_OBJECT = T.StructType(
    [T.StructField("path", T.StringType(), False), T.StructField("content", T.StringType())]
)
ROW_COUNT = T.StructType(
    [T.StructField(name, T.StringType()) for name in TABLE_KEY]
    + [T.StructField("row_count", T.LongType())]
)
SOURCE_COLUMN = T.StructType(
    [T.StructField(name, T.StringType()) for name in TABLE_KEY]
    + [
        T.StructField("column_name", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("orderable", T.BooleanType()),
    ]
)
LOCATION = T.StructType(
    [
        T.StructField("project_id", T.StringType()),
        T.StructField("dataset_id", T.StringType()),
        T.StructField("location", T.StringType()),
    ]
)
CATALOG_TABLE = T.StructType(
    [T.StructField(name, T.StringType()) for name in TABLE_KEY]
    + [T.StructField("labels", T.MapType(T.StringType(), T.StringType()))]
)
SIZE = T.StructType([T.StructField("count", T.LongType()), T.StructField("percentage", T.DoubleType())])
PROPERTIES = T.StructType([T.StructField("by", T.StringType()), T.StructField("direction", T.StringType())])
SPEC = T.StructType([T.StructField("type", T.StringType()), T.StructField("properties", PROPERTIES)])
ORDER = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("route", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("prefix", T.StringType()),
        *(T.StructField(name, T.StringType()) for name in TABLE_KEY),
        T.StructField("size", SIZE),
        T.StructField("spec", SPEC),
        T.StructField("target_project", T.StringType()),
        T.StructField("target_dataset", T.StringType()),
        T.StructField("target_id", T.StringType()),
        T.StructField("target_location", T.StringType()),
    ]
)
OUTCOME = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("started", T.LongType()),
        T.StructField("ended", T.LongType()),
        T.StructField("failure", T.StringType()),
    ]
)
