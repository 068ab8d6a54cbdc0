"""Small state tables kept as numbered versions of a folder.

Parquet has no in-place update: a new version is written beside the old one
and counts once its ``_SUCCESS`` marker is there, so a job that dies half-way
leaves the old version in force, and one that is run again writes the same.

A table that several jobs keep is a series of commits instead: each has the next
number, whoever makes it, and names the job and the batch it is from, so that a
batch run again finds its own commit. One job at a time may commit to a folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, ascending."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def read_version(
    spark: SparkSession, path: str, schema: str, before: int | None = None
) -> DataFrame:
    """The newest complete version (older than ``before``), or an empty table."""
    known = [v for v in versions(spark, path) if before is None or v < before]
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/version={known[-1]}")


def write_version(df: DataFrame, path: str, version: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def prune_versions(spark: SparkSession, path: str, keep: int = 10) -> list[int]:
    """Delete all but the newest ``keep`` complete versions; returns those deleted.

    Keep at least two under a streaming job: a repeated batch reads the version
    before its own.
    """
    doomed = versions(spark, path)[:-keep]
    for version in doomed:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={version}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return doomed


@dataclass(frozen=True, order=True)
class Commit:
    number: int
    job: str
    batch: int

    @property
    def folder(self) -> str:
        return f"commit={self.number}-{self.job}-{self.batch}"


def commits(spark: SparkSession, path: str) -> list[Commit]:
    """The complete commits, ascending."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commit=*/_SUCCESS")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getParent().getName().split("=")[1] for s in fs.globStatus(pattern) or []]
    parts = [name.split("-") for name in names]
    return sorted(Commit(int(number), job, int(batch)) for number, job, batch in parts)


def committed(spark: SparkSession, path: str, job: str, batch: int) -> Commit | None:
    """The commit of a batch, if it has been made."""
    return next((c for c in commits(spark, path) if (c.job, c.batch) == (job, batch)), None)


def read_commit(spark: SparkSession, path: str, schema: str, at: Commit | None = None) -> DataFrame:
    """The table as of a commit (by default the newest), or an empty table."""
    known = commits(spark, path)
    if at is None and not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{(at or known[-1]).folder}")


def write_commit(df: DataFrame, path: str, job: str, batch: int) -> Commit:
    """Make the table's next commit; a batch that has one already leaves it as it is."""
    spark = df.sparkSession
    made = committed(spark, path, job, batch)
    if made is None:
        known = commits(spark, path)
        made = Commit(known[-1].number + 1 if known else 0, job, batch)
        df.write.mode("overwrite").parquet(f"{path}/{made.folder}")
    return made


def prune_commits(spark: SparkSession, path: str, keep: int = 10) -> None:
    """Delete all but the newest ``keep`` commits, but leave each job's newest."""
    known = commits(spark, path)
    last = {c.job: c for c in known}
    for commit in known[:-keep]:
        if last[commit.job] != commit:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{commit.folder}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
