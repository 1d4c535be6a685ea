"""Merge of fallback, default policy, table policies and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleward.functions.compliance import (
    SIZE_FIELDS,
    SPEC_FIELDS,
    fallback_size,
    fallback_spec,
    first_given,
)
from sampleward.functions.config_json import parse_policies, parse_requests
from sampleward.schemas import TABLE_KEY
from sampleward.sources.config_objects import parse_table_path


def table_policies(objects: DataFrame) -> DataFrame:
    """One row per policy object: table key, `limit`, `size`, `spec`."""
    return parse_policies(parse_table_path(objects)).select(*TABLE_KEY, "limit", "size", "spec")


def table_requests(objects: DataFrame) -> DataFrame:
    """One row per request object: table key, `size`, `spec`."""
    return parse_requests(parse_table_path(objects)).select(*TABLE_KEY, "size", "spec")


def default_policy(objects: DataFrame, path: str) -> DataFrame:
    """The default policy object, one row at most."""
    return parse_policies(objects.filter(F.col("path") == path)).select("limit", "size", "spec")


def effective_policy(policies: DataFrame, default: DataFrame) -> DataFrame:
    """Fill what a policy leaves open from the default policy, then from the fallback.

    `limit`, `size` and `spec` are each taken as a whole. The default is a one-row subquery, so
    the policies are neither joined nor shuffled; no default row means the fallback alone.
    """
    given = default.select(F.struct("limit", "size", "spec")).scalar()
    d = F.col("__default")
    return (
        policies.withColumn("__default", given)
        .withColumns(
            {
                "limit": first_given(SIZE_FIELDS, F.col("limit"), d["limit"], fallback_size()),
                "size": first_given(SIZE_FIELDS, F.col("size"), d["size"], fallback_size()),
                "spec": first_given(SPEC_FIELDS, F.col("spec"), d["spec"], fallback_spec()),
            }
        )
        .drop("__default")
    )


def effective_request(policies: DataFrame, requests: DataFrame) -> DataFrame:
    """Lay each table's request, if there is one, over the default sample of its policy."""
    asked = requests.select(
        *TABLE_KEY, F.col("size").alias("__size"), F.col("spec").alias("__spec")
    )
    return (
        policies.join(asked, TABLE_KEY, "left")
        .withColumns(
            {
                "size": first_given(SIZE_FIELDS, F.col("__size"), F.col("size")),
                "spec": first_given(SPEC_FIELDS, F.col("__spec"), F.col("spec")),
            }
        )
        .drop("__size", "__spec")
    )


def orphan_requests(requests: DataFrame, policies: DataFrame) -> DataFrame:
    """Requests for tables without a policy: they are not sampled."""
    return requests.join(policies.select(*TABLE_KEY), TABLE_KEY, "left_anti")
