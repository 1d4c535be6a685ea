"""Policy and request files: strict reading of their JSON text.

An invalid value empties the node that holds it (a bad percentage empties the whole size) and
leaves the nodes beside it alone. Text that is no JSON object gives empty nodes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampleward.functions.text import strip
from sampleward.settings import DEFAULT_SAMPLE_TYPE, DIRECTIONS, SAMPLE_TYPES

MISSING = "VOID"
BIG_INTEGER = r"^DECIMAL\((19|[23]\d),0\)$"
NUMBER = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*)$"
MAX_LONG = 9223372036854775807
NODES = "__nodes"
SIZE_SHAPE = "struct<count:variant,percentage:variant>"
SIZE_PARTS = ["count", "percentage"]
SPEC_SHAPE = "struct<type:variant,properties:struct<by:variant,direction:variant>>"
SPEC_LEAVES = {
    "spec": "spec",
    "type": "parts.type",
    "by": "parts.properties.by",
    "direction": "parts.properties.direction",
}


def with_nodes(df: DataFrame, nodes: Column, leaves: Mapping[str, str]) -> DataFrame:
    """Add the JSON nodes of a document and the type name of each leaf, given as name and path.

    Each step is a column of its own that later steps refer to by name. Nothing is computed twice,
    and the generated code stays in small methods.
    """
    paths = {name: F.col(f"{NODES}.{path}") for name, path in leaves.items()}
    return df.withColumn(NODES, nodes).withColumns(
        {f"__kind_{n}": F.coalesce(F.schema_of_variant(p), F.lit(MISSING)) for n, p in paths.items()}
        | {f"__node_{n}": p for n, p in paths.items()}
    )


def sealed(df: DataFrame, keep: list[str], results: Mapping[str, Column]) -> DataFrame:
    """`keep` and the results. They go through a generator, which filters are not pushed through:
    a pushed filter would repeat the whole computation for each use of a result."""
    row = F.struct(*(column.alias(name) for name, column in results.items()))
    return df.select(*keep, F.inline(F.array(row)))


def node(path: str) -> Column:
    return F.col(f"{NODES}.{path}")


def kind(name: str) -> Column:
    """Type name of a leaf, `VOID` when it is missing or null."""
    return F.col(f"__kind_{name}")


def text(name: str) -> Column:
    """The leaf when it is a string, else null."""
    value = F.try_variant_get(F.col(f"__node_{name}"), "$", "string")
    return F.when(kind(name) == "STRING", value)


def number(name: str) -> Column:
    """The leaf when it is a number, else null."""
    value = F.try_variant_get(F.col(f"__node_{name}"), "$", "double")
    return F.when(kind(name).rlike(NUMBER), value)


def valid_size(count: Column, percentage: Column) -> Column:
    """Size struct, null when a value is out of range or when both are absent."""
    in_range = (count.isNull() | (count >= 0)) & (
        percentage.isNull()
        | (~F.isnan(percentage) & (percentage > F.lit(0.0)) & (percentage <= F.lit(100.0)))
    )
    given = count.isNotNull() | percentage.isNotNull()
    return F.when(
        in_range & given, F.struct(count.alias("count"), percentage.alias("percentage"))
    )


def valid_properties(by: Column, direction: Column) -> Column:
    """Sort properties struct, null unless the column name is clean and the direction known."""
    clean = (F.length(by) > 0) & (strip(by) == by)
    known = F.upper(strip(direction)).isin(DIRECTIONS)
    return F.when(
        F.coalesce(clean & known, F.lit(False)),
        F.struct(by.alias("by"), direction.alias("direction")),
    )


def valid_spec(sample_type: Column, properties: Column) -> Column:
    """Spec struct, null when the type is unknown or when both parts are absent."""
    known = sample_type.isNull() | F.lower(strip(sample_type)).isin(SAMPLE_TYPES)
    given = sample_type.isNotNull() | properties.isNotNull()
    return F.when(
        known & given, F.struct(sample_type.alias("type"), properties.alias("properties"))
    )


def _count(name: str) -> Column:
    """A count; -1 stands for a value of a wrong type and, being out of range, empties the size."""
    whole = F.try_variant_get(F.col(f"__node_{name}"), "$", "bigint")
    return (
        F.when(kind(name) == MISSING, F.lit(None).cast("bigint"))
        .when(kind(name) == "BIGINT", whole)
        .when(kind(name).rlike(BIG_INTEGER) & (number(name) > 0), F.lit(MAX_LONG))
        .otherwise(F.lit(-1).cast("bigint"))
    )


def _percentage(name: str) -> Column:
    return F.when(kind(name) != MISSING, F.coalesce(number(name), F.lit(-1.0)))


def _spec() -> Column:
    """Spec struct; a spec that is no object means random."""
    no_properties = F.lit(None).cast("struct<by:string,direction:string>")
    default = F.struct(F.lit(DEFAULT_SAMPLE_TYPE).alias("type"), no_properties.alias("properties"))
    is_object = node("parts").isNotNull()
    readable = kind("type").isin(MISSING, "STRING")
    return F.when(is_object & readable, valid_spec(F.col("__type"), F.col("__properties"))).when(
        ~is_object & (kind("spec") != MISSING), default
    )


def _parse(objects: DataFrame, content: str, sizes: Mapping[str, str], sample: str) -> DataFrame:
    """Add a size struct per entry of `sizes` (name and path) and the spec of the sample."""
    document = F.col("__document")
    nodes = [
        *(
            F.try_variant_get(document, path, SIZE_SHAPE).alias(name)
            for name, path in sizes.items()
        ),
        F.try_variant_get(document, f"{sample}.spec", "variant").alias("spec"),
        F.try_variant_get(document, f"{sample}.spec", SPEC_SHAPE).alias("parts"),
    ]
    leaves = {f"{name}_{part}": f"{name}.{part}" for name in sizes for part in SIZE_PARTS}
    values = {f"__{name}_count": _count(f"{name}_count") for name in sizes}
    values |= {f"__{name}_percentage": _percentage(f"{name}_percentage") for name in sizes}
    results = {
        name: valid_size(F.col(f"__{name}_count"), F.col(f"__{name}_percentage"))
        for name in sizes
    }
    parsed = with_nodes(
        objects.withColumn("__document", F.try_parse_json(F.col(content))),
        F.struct(*nodes),
        {**leaves, **SPEC_LEAVES},
    ).withColumns(
        {
            **values,
            "__type": text("type"),
            "__by": text("by"),
            "__direction": text("direction"),
        }
    )
    with_properties = parsed.withColumn(
        "__properties", valid_properties(F.col("__by"), F.col("__direction"))
    )
    return sealed(with_properties, objects.columns, {**results, "spec": _spec()})


def parse_requests(objects: DataFrame, content: str = "content") -> DataFrame:
    """Add `size` and `spec` read from the request text in `content`."""
    return _parse(objects, content, {"size": "$.size"}, "$")


def parse_policies(objects: DataFrame, content: str = "content") -> DataFrame:
    """Add `limit`, `size` and `spec` (the default sample) read from the policy text."""
    sizes = {"limit": "$.limit", "size": "$.default_sample.size"}
    return _parse(objects, content, sizes, "$.default_sample")
