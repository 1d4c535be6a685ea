"""Config objects: every file under a root as one row (path, content).

Folders are listed and files read in tasks: the root's own folder first, then each project's, then each dataset's
with all below it, and the files are dealt anew to be read. The driver sees neither names nor contents.
Empty files are kept, unlike in the built-in text and binary readers: an empty policy file means
"use the default policy". Content that is not UTF-8 is null.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleward.functions.text import with_trailing_slash
from sampleward.schemas import CONFIG_OBJECT
from sampleward.settings import JSON_SUFFIX, LISTING_TASKS

FILES_PER_BATCH = 500
# Folders of projects and datasets are listed one by one, what lies deeper with its dataset.
LISTED_DEPTH = 2
ENTRY = "path string, is_folder boolean"

Batches = Iterator[pa.RecordBatch]

# The functions travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def opened(root: str) -> tuple[pafs.FileSystem, str]:
    filesystem, base = pafs.FileSystem.from_uri(root)
    return filesystem, base.rstrip("/")


def entries_of(
    filesystem: pafs.FileSystem, base: str, folder: str, prefix: str, whole: bool
) -> Iterator[tuple[str, bool]]:
    """What one listing of a folder below `base` finds under a prefix: (path, is it a folder); if `whole`, files at any depth."""
    selector = pafs.FileSelector(f"{base}/{folder}".rstrip("/"), allow_not_found=True, recursive=whole)
    for info in filesystem.get_file_info(selector):
        path = info.path[len(base) + 1 :]
        is_file = info.type == pafs.FileType.File
        if path.startswith(prefix) and (is_file or not whole):
            yield path, not is_file


def listing(root: str, prefix: str, whole: bool) -> Callable[[Batches], Batches]:
    """Replaces each folder by what is in it; files are passed on."""

    def run(batches: Batches) -> Batches:
        filesystem, base = opened(root)
        for batch in batches:
            found = []
            for path, is_folder in zip(*(column.to_pylist() for column in batch.columns)):
                found += entries_of(filesystem, base, path, prefix, whole) if is_folder else [(path, False)]
            paths, folders = zip(*found) if found else ((), ())
            arrays = [pa.array(paths, pa.string()), pa.array(folders, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=["path", "is_folder"])

    return run


def reading(root: str) -> Callable[[Batches], Batches]:
    """Adds the content of files; those that are not there (any more) are left out."""

    def run(batches: Batches) -> Batches:
        filesystem, base = opened(root)
        for batch in batches:
            wanted = batch.column("path").to_pylist()
            for start in range(0, len(wanted), FILES_PER_BATCH):
                paths, contents = [], []
                for path in wanted[start : start + FILES_PER_BATCH]:
                    try:
                        if filesystem.get_file_info(f"{base}/{path}").type != pafs.FileType.File:
                            continue
                        with filesystem.open_input_stream(f"{base}/{path}") as stream:
                            content = stream.read().decode("utf-8")
                    except FileNotFoundError:
                        continue
                    except UnicodeDecodeError:
                        content = None
                    paths.append(path)
                    contents.append(content)
                arrays = [pa.array(paths, pa.string()), pa.array(contents, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["path", "content"])

    return run


def list_objects(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Paths of all objects whose path starts with `prefix`, dealt over tasks by name.

    A prefix that names a folder has that one listed, not the whole root.
    """
    tasks = min(LISTING_TASKS, spark.sparkContext.defaultParallelism)
    folder = prefix.rpartition("/")[0]
    entries = spark.range(0, 1, 1, 1).select(F.lit(folder).alias("path"), F.lit(True).alias("is_folder"))
    depth = len(folder.split("/")) if folder else 0
    for level in range(min(depth, LISTED_DEPTH), LISTED_DEPTH + 1):
        entries = entries.mapInArrow(listing(root, prefix, whole=level == LISTED_DEPTH), ENTRY)
        entries = entries.repartition(tasks, "path")
    return entries.select("path")


def scan_config_objects(
    spark: SparkSession, root: str, prefix: str = "", condition: Column | None = None, exact: bool = False
) -> DataFrame:
    """Rows (path, content) of all objects under `root` whose path starts with `prefix`.

    If `exact`, of the object that has just this path, which is looked up without any listing.
    """
    if exact:
        paths = spark.range(0, 1, 1, 1).select(F.lit(prefix).alias("path"))
    else:
        paths = list_objects(spark, root, prefix)
    objects = paths.mapInArrow(reading(root), CONFIG_OBJECT)
    return objects if condition is None else objects.filter(condition)


def parse_table_path(objects: DataFrame, path: str = "path") -> DataFrame:
    """Keep `project/dataset/table.json` objects and add the three names."""
    parts = F.split(F.col(path), "/")
    return (
        objects.filter(F.col(path).endswith(JSON_SUFFIX) & (F.size(parts) == 3))
        .withColumn("project_id", parts[0])
        .withColumn("dataset_id", parts[1])
        .withColumn("table_id", F.regexp_replace(parts[2], r"\.json$", ""))
    )


def list_dataset_prefixes(objects: DataFrame, path: str = "path") -> DataFrame:
    """Distinct `project/dataset/` prefixes of the table config objects."""
    return (
        parse_table_path(objects, path)
        .select("project_id", "dataset_id")
        .distinct()
        .withColumn("prefix", with_trailing_slash(F.concat_ws("/", "project_id", "dataset_id")))
    )


def object_present(objects: DataFrame, object_path: str) -> bool:
    """Whether the object exists; its content does not matter."""
    return bool(objects.filter(F.col("path") == object_path).limit(1).count())
