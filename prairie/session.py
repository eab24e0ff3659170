"""Session settings and the helpers that write intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("prairie")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


OWN_DIR = "prairie.shared.dir"


def name_shared_dir(spark: SparkSession, path: str) -> None:
    """A folder for sessions whose cluster names none, as in tests; a running session cannot take that setting."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set(OWN_DIR, path)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors can reach, as the cluster names it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(OWN_DIR, None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to yet.

    What is written there is removed when the application ends, if not before.
    """
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def forget(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing will read again."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def store(df: DataFrame, name: str = "stored", codec: str = "zstd") -> tuple[DataFrame, str]:
    """Compute ``df`` once into the shared folder; the table read back, and its path.

    The copy survives the loss of executors, ends the lineage of loops and prunes columns.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str = "stored", codec: str = "zstd") -> DataFrame:
    """Like :func:`store`, where the path is not needed."""
    return store(df, name, codec)[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
