"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

_own_roots: dict[str, str] = {}
_written: list[str] = []


def _on_one_machine(master: str) -> bool:
    return master.startswith("local")


def scratch_root(setting: str | None, master: str, application: str) -> str:
    """The session's shared folder; a temporary one only for a local session that names none.

    On a cluster a folder for temporary files is refused: every executor would write to its own.
    """
    if setting:
        root = setting.rstrip("/")
        path = "/" + root.removeprefix("file:").strip("/") + "/"
        temporary = ("/tmp/", "/var/tmp/", "/dev/shm/", tempfile.gettempdir().rstrip("/") + "/")
        if not _on_one_machine(master) and path.startswith(temporary):
            raise ValueError(f"{SETTING} is {setting}, which executors don't share")
        return root
    if not _on_one_machine(master):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    if application not in _own_roots:
        _own_roots[application] = tempfile.mkdtemp(prefix="refrain-")
    return _own_roots[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    context = spark.sparkContext
    root = scratch_root(spark.conf.get(SETTING, None), context.master, context.applicationId)
    path = f"{root}/refrain/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def settle(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` written once and read back: later uses neither recompute it nor depend on a lost executor.

    The job that writes it runs when this is called. ``compression`` is the codec if not the session's: for rows of
    megabytes ``zstd``, which unlike Snappy unpacks them without buffers outside of the heap.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write if compression is None else df.write.option("compression", compression)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Deletes the intermediate tables that are written inside the block, when it ends.

    What the block computes must be stored elsewhere, or collected, before that.
    """
    before = len(_written)
    try:
        yield
    finally:
        paths = _written[before:]
        del _written[before:]
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
