"""Session helpers: table loading, checkpoint folder, lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data folder; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    ``spark.checkpoint.dir`` of the session is used as it is. Where it is unset a
    temporary folder is taken, but only if all runs in this process: on a cluster
    other workers wouldn't find it, so that is an error.
    """
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    wanted = spark.conf.get("spark.checkpoint.dir", None)
    if not wanted and sc.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all workers share")
    sc.setCheckpointDir(wanted or tempfile.mkdtemp(prefix="lexgrain-ckpt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages survive the loss of any executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def joined(a: DataFrame, b: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join by shuffle and merge, whatever sizes are estimated: behind a Python
    step or a cut the estimates are far too small, and a side that grows with the
    data would be broadcast."""
    return a.join(b.hint("merge"), on, how)


def collect_bounded(df: DataFrame, most: int) -> list:
    """All rows of a table that is known to be small; an error, never a cut,
    where it has more than ``most``."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows where a small table was expected")
    return rows


def stamp(spark: SparkSession, path: str) -> str:
    """What tells a table's state apart: sizes and times of its files."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return ",".join(sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.listStatus(p)))
