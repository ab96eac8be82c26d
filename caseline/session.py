"""Session settings the jobs rely on, and the way they cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# UTC because timestamps are turned into dates; adaptive execution splits the hot keys of joins;
# plans of several thousand expressions build several times faster without call-site capture; generated
# methods above the size that the JVM compiles are much slower than the same expressions in small ones;
# constraints of plans with many renamed columns multiply while planning and say little of them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.constraintPropagation.enabled": "false",
}
# Of these, the ones that wide plans need in a session that comes from elsewhere.
WIDE = ("spark.sql.codegen.hugeMethodLimit", "spark.sql.constraintPropagation.enabled")


PARTITION_BYTES = 128 << 20


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Partitions that keep each one near 128 MB, at least Spark's default of 200.

    Adaptive execution merges partitions that turn out small but never splits an aggregation's, so
    the number has to be large enough beforehand.
    """
    return max(200, -(-shuffled_bytes // PARTITION_BYTES))


def builder(app_name: str = "caseline", shuffled_bytes: int | None = None) -> SparkSession.Builder:
    """A session builder with the settings above.

    Master and memory are left to the caller. ``shuffled_bytes`` is the size of the largest table
    after pruning; it sets the number of shuffle partitions.
    """
    b = SparkSession.builder.appName(app_name)
    for name, value in SETTINGS.items():
        b = b.config(name, value)
    if shuffled_bytes is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions(shuffled_bytes)))
    return b


def with_small_methods(spark: SparkSession) -> SparkSession:
    """``spark`` with the settings above that wide plans need.

    For a session that comes from elsewhere: the JVM only interprets larger methods, and the constraints of a
    plan take longer to derive than the plan takes to run.
    """
    for name in WIDE:
        spark.conf.set(name, SETTINGS[name])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, which the whole cluster shares.

    Only a local session that names none, as in tests, gets a folder of its own; a cluster must name one
    that its executors share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="caseline-")
    return folder.rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for tables that a job writes and reads again."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: lineage ends there."""
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
