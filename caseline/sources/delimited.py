"""Readers for tab-separated extracts, their row-count manifest and their lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseline.functions.text import snake_names, squish
from caseline.operators.repair import OVERFLOW

MANIFEST_TOLERANCE = 5


def read_ragged(spark: SparkSession, path: str) -> DataFrame:
    """Read a ragged table as text columns named by its header line.

    Quotes have no meaning. Short rows are padded with NULL, empty cells are NULL, and cells beyond
    the header go into the array column ``_overflow``, so no pass over the data is needed to learn
    the widest row.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    first = lines.head(1)
    if not first:
        raise ValueError(f"no header line in {path}")
    header = first[0][0]
    names = header.rstrip("\r").lstrip("﻿").split("\t")
    return split_cells(_without_header(lines, header), names)


def _without_header(lines: DataFrame, header: str) -> DataFrame:
    """All lines but the header line of each file; data lines that equal it stay.

    A single file's first line is the first row of the task that reads its first block. Tasks may pack
    several files, so for those the lines equal to a header are counted per file, and one of each file
    goes: they are alike, so it doesn't matter which.
    """
    if len(lines.inputFiles()) == 1:
        placed = lines.select("value", F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
        is_first = (F.col("_block") == 0) & (F.col("_at").bitwiseAND((1 << 33) - 1) == 0)
        return placed.where(~is_first).select("value")
    alike = lines.where(F.col("value") == header).groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias("_n"))
    kept = alike.where("_n > 1").select(F.explode(F.array_repeat(F.lit(header), (F.col("_n") - 1).cast("int"))).alias("value"))
    return lines.where(F.col("value") != header).unionByName(kept)


def split_cells(lines: DataFrame, names: list[str]) -> DataFrame:
    """Lines of text (``value``) as named cells; what goes beyond the names is in ``_overflow``."""
    width = len(names)
    split = lines.select(F.split(F.regexp_replace("value", "\r$", ""), "\t", -1).alias("cells"))
    cells = [F.nullif(F.trim(F.get("cells", F.lit(i))), F.lit("")).alias(name) for i, name in enumerate(names)]
    extra = F.when(F.size("cells") > width, F.slice("cells", width + 1, F.size("cells")))
    return split.select(*cells, extra.alias(OVERFLOW))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Expected row counts: lines of table name, tab, number."""
    return parse_manifest(spark.read.text(path))


def parse_manifest(lines: DataFrame) -> DataFrame:
    """Table names and numbers of lines that hold both; other lines go."""
    return lines.select(
        F.regexp_extract("value", r"^([^\t]+)\t", 1).alias("table_name"),
        F.regexp_extract("value", r"\t(\d+)\r?$", 1).try_cast("long").alias("expected"),
    ).where((F.col("table_name") != "") & F.col("expected").isNotNull())


def manifest_check(counts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Compare ``(table_name, actual)`` with the manifest; five rows of difference warn."""
    unique = manifest.groupBy("table_name").agg(
        F.min("expected").alias("expected"), F.count(F.lit(1)).alias("lines")
    ).where("lines = 1")
    joined = counts.join(unique.drop("lines"), "table_name", "left")
    diff = F.abs(F.col("actual") - F.col("expected"))
    return joined.select(
        "table_name",
        "actual",
        "expected",
        diff.alias("diff"),
        F.when(diff >= MANIFEST_TOLERANCE, "warn").otherwise("pass").alias("level"),
    )


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Read a code table: NUL bytes removed, snake-case names, squished text, empty cells NULL."""
    raw = (
        spark.read.option("header", "true")
        .option("sep", "\t")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", "true")
        .option("nullValue", "")
        .option("emptyValue", "")
        .csv(path)
    )
    return clean_lookup(raw)


def clean_lookup(raw: DataFrame) -> DataFrame:
    """Text columns without NUL bytes, with snake-case names and squished text; empty cells are NULL."""
    names = snake_names([c.replace("\x00", "").lstrip("﻿") for c in raw.columns])
    columns = []
    for old, new in zip(raw.columns, names):
        text = F.regexp_replace(F.col(f"`{old}`"), "\x00", "")
        columns.append(F.when(text != "", squish(text)).alias(new))
    return raw.select(*columns)
