"""Where working tables go: below the folder the session names for checkpoints; and how functions over
Arrow batches get to the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import sparkmart


# Folders made for local sessions, by application.
_local_folders: dict[str, str] = {}
# Applications whose executors already have the package.
_shipped: set[str] = set()


def _temporary_folders() -> set[str]:
    return {"/tmp", "/var/tmp", tempfile.gettempdir().rstrip("/")}


def shared_folder(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``.

    Only a local session without that setting (unit tests) gets a folder of its
    own; a cluster session without it is refused, since a machine-local folder
    would vanish with the machine that holds it. A plain path is taken to be a mount that all
    machines share, which cannot be told from the path; one below a machine's temporary folder
    is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    local = context.master.startswith("local")
    if configured and ("://" in configured or configured.startswith(("/", "file:/"))):
        path = "/" + configured.removeprefix("file:").lstrip("/")
        if not local and any(path.startswith(f"{folder}/") for folder in _temporary_folders()):
            raise ValueError(f"spark.checkpoint.dir is a machine's temporary folder: {configured}")
        return configured.rstrip("/")
    if configured and local:
        return os.path.abspath(configured)
    if not local:
        raise ValueError("set spark.checkpoint.dir to the full path of a shared folder")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="sparkmart-")
    return _local_folders[context.applicationId]


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/sparkmart/{label}/{uuid.uuid4().hex}"


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that functions of its
    modules run there wherever the repository lies on the driver."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(sparkmart.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="sparkmart-code-"), "sparkmart_code.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.join("sparkmart", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with the package present on the executors.

    A worker process outlives its task, so memory that the task has freed is given back after it.
    """
    ship_code(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            pa.system_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
