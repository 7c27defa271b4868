"""Session set-up, table loading and the shared folder for intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "8", memory: str = "12g", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("loomspan")
    options = DEFAULTS | {
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.host": "127.0.0.1",
    }
    for key, value in (options | conf).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table; columns and filters are pushed down by the caller's plan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by the cluster in spark.checkpoint.dir.

    Only a local session without the setting gets a folder of its own; a
    cluster without it is an error, since a machine-local folder would be lost
    with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="loomspan-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/loomspan/{label}-{uuid.uuid4().hex}"


def persisted(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Cut the lineage: write `df` as a table in the shared folder and read it back.

    The files survive the loss of any executor, and Parquet keeps them smaller
    than a checkpoint of rows.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that `persisted` made and nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        drop_path(spark, folder)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path on whatever file system it is on."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that no query needs any more.

    It does so when the driver's JVM collects their handles, which without this
    may be long after a step that has been written as a table. The first round
    lets go of what Python still holds in the JVM.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def drop_intermediate(spark: SparkSession) -> None:
    """Delete all intermediate tables of this library; results that still read them are lost."""
    drop_path(spark, f"{shared_dir(spark)}/loomspan")
