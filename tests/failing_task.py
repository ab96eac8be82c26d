"""Run by a test in a session of its own: one task fails at first, and the counts of committed files are exact."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from caseline.plans import build, stages  # noqa: E402
from caseline.plans.extracts import HISTORY  # noqa: E402
from caseline.session import builder  # noqa: E402


def flaky(batches):
    """The rows as they are; the second task fails after its rows in its first attempt."""
    task = TaskContext.get()
    yield from batches
    if task.partitionId() == 1 and task.attemptNumber() == 0:
        raise OSError("lost")


def main(folder: str) -> None:
    spark = builder("flaky").master("local[2,3]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    key = F.col("id").cast("string")
    cells = {"IDNCUSTODY": key, "IDNCASE": (F.col("id") % 40).cast("string"), "CUSTODY": F.when(F.col("id") % 500 == 0, "Z").otherwise("D"),
             "DATDETAINED": F.lit("2001-2-3 00:00:00"), "DATRELEASED": F.when(F.col("id") % 1000 == 7, "soon")}
    raw = spark.range(0, 2000, 1, 4).select(*[(cells.get(c, F.lit(None))).cast("string").alias(c) for c in HISTORY])
    lookups = {"tblLookupCustodyStatus": spark.createDataFrame([("D", "detained")], "str_code string, str_description string")}
    stage = stages.custody(raw.mapInPandas(flaky, raw.schema), lookups)
    stage.checked.write.parquet(f"{folder}/rows")
    checked = spark.read.parquet(f"{folder}/rows")
    counts, lines = build.repair.counts_of(checked).first().asDict(), stage.row_lines(checked).collect()
    print(json.dumps({"rows_in": counts["rows_in"], "failed": {r["rule"]: [r["failed"], r["total"]] for r in lines if r["failed"]}}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
