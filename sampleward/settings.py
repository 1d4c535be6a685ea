"""Fixed values and the parameters of one sampling cycle."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

# Fixed values of the config files and of the command messages.
JSON_SUFFIX = ".json"
SAMPLE_TYPES = ["random", "sorted"]
DEFAULT_SAMPLE_TYPE = "random"
DIRECTIONS = ["ASC", "DESC"]
COMMAND_TYPES = [
    "START",
    "SAMPLE_POLICY_PREFIX",
    "SAMPLE_START",
    "SAMPLE_DONE",
    "TRANSFER_RUN_DONE",
    "REMOVE_DATASET",
]
SAMPLE_LABELS = {"sample_table": "true"}
TRANSFER_OK_STATE = "SUCCEEDED"
ERROR_SEPARATOR = "+++"
ERROR_TEXT = "The command was not carried out: %s"
IDENTIFIER_LENGTH = 1023
STAGING_PART_LENGTH = 200

# Schema property that names the location of its data.
LOCATION_PROPERTY = "data_location"

# Schema property with the end of the lease of a staging schema, in seconds of the epoch.
LEASE_PROPERTY = "lease_until"
# A step of a copy to another location takes no longer; a replaced sample stays so long for those who read it.
LEASE_SECONDS = 86_400
KEEP_SECONDS = 3_600

# Fixed values of the fallback policy: one row, picked at random.
FALLBACK_COUNT = 1

# Most rows that one task may gather: rows of fixed length, and rows with text or nested values.
SINGLE_TASK_ROWS = 200_000
SINGLE_TASK_WIDE_ROWS = 20_000
# Rows expected in one scan task, and the fewest rows worth a task of their own when writing.
SCAN_TASK_ROWS = 500_000
WRITE_TASK_ROWS = 10_000
# A table of so many rows is not worth a look at its sort column before its rows are read.
SMALL_TABLE_ROWS = 1_000_000
# Values of a sort column looked at to bracket a threshold.
BRACKET_ROWS = 100_000
# Tasks that list folders or read config objects at the same time, where there are as many cores.
LISTING_TASKS = 64


@dataclass(frozen=True)
class CycleConfig:
    """Where one cycle reads its config and tables from and where it writes the samples."""

    policy_root: str
    request_root: str
    target_project: str
    target_root: str
    target_location: str | None = None
    default_policy_path: str = "default_policy.json"
    lock_path: str = "sampling.lock"
    source_catalogs: Mapping[str, str] = field(default_factory=dict)
    location_roots: Mapping[str, str] = field(default_factory=dict)
    target_schema_prefix: str = "sample_"
    staging_prefix: str = "sampleward_staging_"
    log_schema: str = "sampleward_log"
    labels: Mapping[str, str] = field(default_factory=dict)
    random_by_block: bool = False
    seed: int | None = None  # None: every cycle draws anew
    parallelism: int = 8
    attempts: int = 3
    retry_wait: tuple[float, float] = (4.0, 10.0)
    single_task_rows: int | None = None
    lease_seconds: int = LEASE_SECONDS
    keep_seconds: int = KEEP_SECONDS

    def target_schema(self, dataset: str) -> str:
        """As `valid_identifier` names it."""
        return re.sub("[^A-Za-z0-9_]", "_", f"{self.target_schema_prefix}{dataset}")[:IDENTIFIER_LENGTH].lower()

    def source_name(self, project: str, dataset: str, table: str) -> str:
        catalog = self.source_catalogs.get(project, "spark_catalog")
        return ".".join("`" + part.replace("`", "``") + "`" for part in (catalog, dataset, table))
