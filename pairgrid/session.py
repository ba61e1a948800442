"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench. A cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pairgrid")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder named in ``spark.checkpoint.dir``.

    Every executor must see what is written there. A machine-local folder is
    used only on a local master with the setting unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        # The setting can't be changed in a running session, so the folder is remembered here.
        app = spark.sparkContext.applicationId
        root = _LOCAL_ROOTS.get(app) or _LOCAL_ROOTS.setdefault(app, tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def keep_dealt(spark: SparkSession) -> None:
    """Let joins of this session use rows as they lie, if both sides are dealt by some of the join keys.

    By default Spark deals both sides anew by all keys, against skew; scenes are bounded.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several later steps read, and read it back.

    It is then computed once, its lineage is cut, and a lost executor costs a
    re-read and not a re-run. Hashes make up most of many tables, and zstd halves their hex.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
