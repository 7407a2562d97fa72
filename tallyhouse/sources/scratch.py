"""The shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a folder of its own; a cluster must name
    storage that every executor reaches.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{SETTING} must name a shared folder on a cluster")
    known = spark.sparkContext.getCheckpointDir()
    if known is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyhouse-"))
        known = spark.sparkContext.getCheckpointDir()
    return known.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage through reliable storage, so that lost executors replay nothing before it."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """A result written once to shared storage and read back, for callers that read it several times."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in any storage that Spark writes; nothing happens if it isn't there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files that finished jobs have left on disk.

    Spark deletes them when the driver's JVM collects the plans that wrote them, which by itself may be long after.  Those of the
    last job may still be held and go with the next call.
    """
    spark._jvm.java.lang.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    if not path.startswith(shared_folder(spark) + "/"):
        raise ValueError(f"{path} is not in the shared folder")
    delete_folder(spark, path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """`stored` for the steps of one eager operation, whose tables are deleted when it ends."""
    paths: list[str] = []

    def stage(df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(spark, name)
        paths.append(path)
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield stage
    finally:
        for path in paths:
            discard(spark, path)


#: Tables written once per application and load: where they are, and the catalogue's name of those in buckets.
_shared: dict[tuple[str, str, str], tuple[str, StructType, str | None]] = {}


def fingerprint(spark: SparkSession, folder: str) -> str:
    """The state of a folder's Parquet files: how many, how large, how old.  Tables written anew have another one."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    listed = files.load(folder).select("length", F.unix_micros("modificationTime").alias("at"))
    found = listed.agg(F.count("*"), F.sum("length"), F.max("at"), F.sum(F.col("at").cast("decimal(20,0)"))).first()
    return "-".join(str(value) for value in found)


def forget_shared(spark: SparkSession) -> None:
    """Delete the tables that `shared` has written in this application."""
    own = [key for key in _shared if key[0] == spark.sparkContext.applicationId]
    for key in own:
        path, _, table = _shared.pop(key)
        if table is not None:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        discard(spark, path)


def shared(
    spark: SparkSession, load: str, name: str, build: Callable[[], DataFrame], buckets: int = 0, by: str | None = None
) -> DataFrame:
    """A table that several results of one load read: written by the first of them, read by all.

    ``load`` names the input and its state, see `fingerprint`.  With ``by`` the table lies in buckets of that column, so what
    groups or joins by it (and maybe further columns) needs no shuffle; rows that come in as many hash partitions of the
    column make one file a bucket.
    """
    key = (spark.sparkContext.applicationId, load, name)
    if key not in _shared:
        df, path = build(), fresh_path(spark, name)
        release(spark)  # what the tables before it have shuffled doesn't lie beside its own shuffles
        writer, table = df.write.option("compression", "zstd"), None
        if by is None:
            writer.parquet(path)
        else:
            table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
            writer.format("parquet").option("path", path).bucketBy(buckets, by).saveAsTable(table)
        _shared[key] = (path, df.schema, table)
        release(spark)
    return known_shared(spark, load, name)


def share(spark: SparkSession, load: str, name: str, path: str, schema: StructType) -> DataFrame:
    """A table that lies in the shared folder already becomes a shared one; ``schema`` names the columns that are read."""
    if not path.startswith(shared_folder(spark) + "/"):
        raise ValueError(f"{path} is not in the shared folder")
    _shared[(spark.sparkContext.applicationId, load, name)] = (path, schema, None)
    return known_shared(spark, load, name)


def known_shared(spark: SparkSession, load: str, name: str) -> DataFrame | None:
    """A shared table if it has been written."""
    found = _shared.get((spark.sparkContext.applicationId, load, name))
    if found is None:
        return None
    path, schema, table = found
    if table is not None:
        return spark.table(table)
    rows = spark.read.schema(schema).parquet(path)
    # The folder of a table that was cut into partitions names one column more.
    return rows if rows.columns == schema.names else rows.select(*[F.col(f"`{c}`") for c in schema.names])
