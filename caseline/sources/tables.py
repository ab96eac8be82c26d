"""Parquet tables between the stages, the postal crosswalk and earlier releases."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseline.operators.columns import project


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_optional(spark: SparkSession, path: str | None) -> DataFrame | None:
    """An earlier release, or None if there is none."""
    if path is None:
        return None
    if exists(spark, f"{path.rstrip('/')}/{POINTER}"):
        return read_current(spark, path)
    return spark.read.parquet(path) if exists(spark, path) else None


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """Postal-area crosswalk with one row per area."""
    return crosswalk_columns(spark.read.parquet(path))


def crosswalk_columns(raw: DataFrame) -> DataFrame:
    return project(
        raw,
        zcta="zcta",
        state="stusps",
        state_fips_code=F.substring("county_geoid", 1, 2),
        county="county",
        county_fips_code="county_geoid",
        place="place",
        place_fips_code="place_geoid",
    )


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _absolute(spark: SparkSession, path: str) -> str:
    where, files = _files(spark, path)
    return files.makeQualified(where).toString()


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _files(spark, path)
    return files.exists(where)


# --- snapshots: versions of a table, and a pointer to the one that readers see ---

POINTER = "CURRENT"
VERSIONS = "versions"


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version that readers see, None before the first one is published."""
    pointer = f"{root.rstrip('/')}/{POINTER}"
    if not exists(spark, pointer):
        return None
    return spark.read.text(pointer).first()[0]


def read_current(spark: SparkSession, root: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published at {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{VERSIONS}/{version}")


def write_version(df: DataFrame, root: str) -> str:
    """Write ``df`` as a new version that no reader sees yet; return its name, which sorts by time."""
    version = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    df.write.option("compression", "zstd").parquet(f"{root.rstrip('/')}/{VERSIONS}/{version}")
    return version


def point_to(spark: SparkSession, root: str, version: str) -> None:
    """Let readers see a written version: the pointer is written aside and renamed over the old one.

    The rename replaces the file in one step where the file system can do so, as HDFS and local ones can; a
    failure before it leaves the earlier version in place. Any earlier version can be pointed to again.
    """
    jvm, root = spark._jvm, root.rstrip("/")
    if not exists(spark, f"{root}/{VERSIONS}/{version}/_SUCCESS"):
        raise FileNotFoundError(f"version {version} of {root} is not complete")
    aside, files = _files(spark, f"{root}/_{POINTER}-{uuid.uuid4().hex}")
    out = files.create(aside)
    out.write(bytearray(version.encode()))
    out.close()
    options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    replace = spark.sparkContext._gateway.new_array(options, 1)
    replace[0] = options.OVERWRITE
    target = jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(aside, target, replace)


def versions(spark: SparkSession, root: str) -> list[str]:
    """All complete versions, the oldest first."""
    where, files = _files(spark, f"{root.rstrip('/')}/{VERSIONS}")
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where)]
    return sorted(n for n in names if exists(spark, f"{root.rstrip('/')}/{VERSIONS}/{n}/_SUCCESS"))


def prune_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all but the newest ``keep`` versions and the current one; return the removed ones."""
    if keep < 1:
        raise ValueError("at least one version stays")
    old = [v for v in versions(spark, root)[:-keep] if v != current_version(spark, root)]
    for version in old:
        where, files = _files(spark, f"{root.rstrip('/')}/{VERSIONS}/{version}")
        files.delete(where, True)
    return old


# --- bucketed tables: the partitioning of a by-case table is kept across jobs ---


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write a by-case table as one file per bucket of its key, and read it back.

    Where ``df`` comes hashed on the key into as many partitions, as after a collapse with that
    number of shuffle partitions, nothing is shuffled for it; otherwise its rows are hashed here, once.
    """
    spark = df.sparkSession
    if not (_collapsed(df, key) and int(spark.conf.get("spark.sql.shuffle.partitions")) == buckets):
        df = df.repartition(buckets, key)
    name, path = f"written_{uuid.uuid4().hex}", _absolute(spark, path)
    df.write.format("parquet").mode("overwrite").option("compression", "zstd").option("path", path).bucketBy(buckets, key).sortBy(
        key
    ).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, as their place was given
    return read_bucketed(spark, path, key, buckets, df)


def _collapsed(df: DataFrame, key: str) -> bool:
    """Whether the plan deals rows by the key alone."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.initialPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    return re.match(rf"hashpartitioning\({re.escape(key)}#\d+L?, \d+", plan.outputPartitioning().toString()) is not None


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int, like: DataFrame | None = None) -> DataFrame:
    """A bucketed table as this or another session wrote it: joins and groups on the key need no exchange."""
    schema = (like if like is not None else spark.read.parquet(path)).schema
    name, path = f"bucketed_{uuid.uuid4().hex}", _absolute(spark, path)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Save a by-case table in the session's catalog, bucketed on its key."""
    writer = df.write.mode("overwrite").format("parquet").option("compression", "zstd")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
