"""Intermediate results that outlive a lost executor: written to the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Paths of what ``keep`` wrote and nobody dropped, by application.
_written: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder (``spark.checkpoint.dir``, or the one set on the context).

    Where none is named a temporary one is made, but only for a local master, as in tests: on a cluster every executor would write to a disk of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    current = sc.getCheckpointDir()
    if current is None:
        if not single_machine(sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='recordloom-')}")
        current = sc.getCheckpointDir()
    return current


def single_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def keep(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there."""
    spark = df.sparkSession
    shared_folder(spark)
    out = df.checkpoint()
    path = _path(out)
    if path:
        _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return out


def _path(kept: DataFrame) -> str | None:
    plan = kept._jdf.queryExecution().logical()
    file = plan.rdd().getCheckpointFile() if plan.nodeName().startswith(("LogicalRDD", "ExistingRDD", "Scan")) else None
    return file.get() if file is not None and file.isDefined() else None


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop(kept: DataFrame) -> None:
    """Deletes what ``keep`` wrote, when nothing that is still to run reads it."""
    path, spark = _path(kept), kept.sparkSession
    written = _written.get(spark.sparkContext.applicationId, [])
    if path in written:
        written.remove(path)
        delete(spark, path)


def mark(spark: SparkSession) -> int:
    return len(_written.get(spark.sparkContext.applicationId, []))


def drop_since(spark: SparkSession, since: int) -> None:
    """Deletes all that ``keep`` wrote since a ``mark``: for a caller whose result is written down itself."""
    written = _written.get(spark.sparkContext.applicationId, [])
    for path in written[since:]:
        delete(spark, path)
    del written[since:]


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a folder of its own, not made yet, within the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
