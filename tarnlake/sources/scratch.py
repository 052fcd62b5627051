"""Where jobs put written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL: dict[str, str] = {}


def refuse_unless_local(master: str) -> None:
    if not re.match(r"local(\[|$)", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``).

    Where that is unset, a local session gets a temporary folder, one per application. Any other
    is refused: its executors would each write to a disk of their own, and reads would miss rows.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        refuse_unless_local(spark.sparkContext.master)
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="tarnlake-")
        root = _LOCAL[app]
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/tarnlake/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: it is computed once, lineage ends there, lost executors lose nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
