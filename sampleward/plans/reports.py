"""Dry runs: what a cycle would grant, without sampling anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleward.plans.effective import effective_policy, effective_request
from sampleward.plans.jobs import compliant_plan
from sampleward.schemas import TABLE_KEY


def policy_request_dry_run(
    policies: DataFrame, requests: DataFrame, default: DataFrame
) -> DataFrame:
    """Each request with its effective policy and sample; `has_policy` tells whether it has one."""
    effective = effective_request(effective_policy(policies, default), requests)
    return requests.select(*TABLE_KEY).join(
        effective.withColumn("__found", F.lit(True)), TABLE_KEY, "left"
    ).select(
        *TABLE_KEY,
        F.coalesce("__found", F.lit(False)).alias("has_policy"),
        "limit",
        "size",
        "spec",
    )


def sample_request_dry_run(
    policies: DataFrame, requests: DataFrame, default: DataFrame, row_counts: DataFrame
) -> DataFrame:
    """The sample each request would get at the row counts the user supplies."""
    effective = effective_request(effective_policy(policies, default), requests)
    asked = effective.join(requests.select(*TABLE_KEY), TABLE_KEY, "left_semi")
    return compliant_plan(asked, row_counts)
