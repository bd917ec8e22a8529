"""Written intermediate tables.

A result that several steps must see identically, or that an iteration builds on, is written as
parquet to the shared checkpoint folder and read back: that cuts the lineage, survives the loss of
executors, and gives the optimizer true sizes.
"""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_scopes: list[str] = []
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables: below ``spark.checkpoint.dir``, else below
    the checkpoint folder set on the context. Local mode without either takes a temporary folder."""
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="namekin-")
        spark.conf.set(CHECKPOINT_DIR, base)
    return f"{base.rstrip('/')}/namekin-{spark.sparkContext.applicationId}"


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Intermediate tables written inside the block are removed when it ends.

    Results that are still to be read must be written elsewhere before that.
    """
    root = scratch_root(spark)
    scope = f"scope-{uuid.uuid4().hex}"
    _scopes.append(scope)
    try:
        yield
    finally:
        _scopes.remove(scope)
        jvm = spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{root}/{scope}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def outside_scope():
    """What is written inside the block belongs to the scope around the innermost one, and outlives that."""
    scope = _scopes.pop()
    try:
        yield
    finally:
        _scopes.append(scope)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the scratch folder."""
    return "/".join([scratch_root(spark), *_scopes[-1:], f"{label}-{uuid.uuid4().hex}"])


def written(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the scratch folder now and return a scan of what was written.

    The shuffle files of the write are removed as soon as it has ended: nothing reads them again. ``codec``
    stands for the usual compression; ``zstd`` takes some more time and far less space for texts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
