"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A test item is leaked if at least ``threshold`` of its word n-grams stand in one document. Items are
partitioned by their number of n-grams, and each partition has a sketch size: of the n-grams of an item
in hash order, so many of the smallest that a document holding the threshold share must hold one of
them. Documents, however long, are searched for those minima alone; what they meet is then verified on
all n-grams of the item. A sketch of that size misses nothing, so recall is 1 by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseline.llm.common import let, whole, written
from caseline.operators.joins import bounded

NGRAM = 5
THRESHOLD = 0.8
#: What stands between words.
GAP = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), GAP, -1), "")


def grams(words: Column, n: int | Column) -> Column:
    """64-bit hashes of the distinct ``n``-grams of ``words``; none if there are fewer words."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(
        F.size(words) >= n,
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.xxhash64(F.slice(words, i, n)))),
    ).otherwise(F.array().cast("array<long>"))


def sketch_size(size: Column, threshold: float) -> Column:
    """Smallest hashes that a document with the threshold share of ``size`` n-grams cannot all lack."""
    return (size - F.ceil(size * F.lit(threshold) - 1e-9) + 1).cast("int")


def indexed(items: DataFrame, n: int, threshold: float) -> DataFrame:
    """Items with their n-gram width (less than ``n`` for items of fewer words), n-grams and sketch.

    All items of one power of two of sizes form a partition and get the sketch that its largest needs.
    """
    made = items.select("item_id", tokens(whole(F.col("text"))).alias("w")).where(F.size("w") > 0)
    made = made.select("item_id", F.least(F.size("w"), F.lit(n)).alias("width"), "w")
    made = made.select("item_id", "width", F.array_sort(grams(F.col("w"), F.col("width"))).alias("grams")).distinct()
    made = made.withColumn("size", F.size("grams"))
    made = made.withColumn("partition", F.floor(F.log2("size")).cast("int"))
    most = (F.pow(F.lit(2.0), F.col("partition") + 1) - 1).cast("long")
    return made.withColumn("sketch", F.slice("grams", F.lit(1), F.least(F.col("size"), sketch_size(most, threshold))))


def _verified(docs: DataFrame, items: DataFrame, threshold: float, n: int) -> DataFrame | None:
    """(doc_id, th, key, n_shared, item_id, n_grams): the text of hash ``th`` holds the item; None without items."""
    index = indexed(items, n, threshold)
    index = index.withColumn("key", F.xxhash64("item_id", F.col("width"), "grams"))
    widths = [r["width"] for r in index.select("width").distinct().collect()]  # at most n values
    found = None
    for width in sorted(widths):
        part = index.where(F.col("width") == width)
        texts = docs.select("doc_id", F.xxhash64("text").alias("th"), whole(F.col("text")).alias("text"))
        held = texts.select("doc_id", "th", F.explode(let(tokens(F.col("text")), lambda w: grams(w, width))).alias("gram"))
        minima = bounded(part.select("key", F.explode("sketch").alias("gram")))
        met = written(held.join(minima, "gram").select("doc_id", "th", "key").distinct(), "candidates")
        picked = bounded(met.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct())
        again = texts.join(picked, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left_semi")
        held = again.select("doc_id", "th", F.explode(let(tokens(F.col("text")), lambda w: grams(w, width))).alias("gram"))
        every = bounded(part.select("key", "item_id", "size", F.explode("grams").alias("gram")))
        # an item is verified where it met a document; repeated rows (same id and text) are one here
        pairs = met.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), F.col("key").alias("_key"))
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")) & (F.col("key") == F.col("_key"))
        shared = (
            held.join(every, "gram")
            .join(pairs, same, "left_semi")
            .groupBy("doc_id", "th", "key")
            .agg(F.countDistinct("gram").alias("n_shared"), F.first("item_id").alias("item_id"), F.first("size").alias("n_grams"))
            .where(F.col("n_shared") >= F.col("n_grams") * F.lit(threshold) - 1e-9)
        )
        found = shared if found is None else found.unionByName(shared)
    return found


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = NGRAM) -> DataFrame:
    """Pairs (doc_id, item_id, n_shared, n_grams, containment) of documents and items leaked into them.

    Items or texts without words match nothing. Items of fewer than ``n`` words are one n-gram of their
    own length. Rows of ``docs`` with the same id count one by one; the pair is returned once with the
    largest containment. Rows of ``items`` with the same id and n-grams are one item; with other
    n-grams, the best is returned. Null ids are ids like others. Columns other than doc_id, item_id and
    text are ignored. Empty tables give an empty result.
    """
    found = _verified(docs, items, threshold, n)
    if found is None:
        return items.limit(0).select(
            F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "item_id", F.lit(0).cast("long").alias("n_shared"), F.lit(0).cast("long").alias("n_grams"),
            F.lit(0.0).alias("containment"),
        )
    share = F.col("n_shared") / F.col("n_grams")
    best = F.max(F.struct(share.alias("containment"), F.col("n_shared"), F.col("n_grams"))).alias("_b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id",
        "item_id",
        F.col("_b.n_shared").cast("long").alias("n_shared"),
        F.col("_b.n_grams").cast("long").alias("n_grams"),
        "_b.containment",
    )


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = NGRAM) -> DataFrame:
    """``docs`` without the rows whose own text holds a leaked item; other rows of the same id stay."""
    found = _verified(docs, items, threshold, n)
    if found is None:
        return docs
    leaking = found.select(F.col("doc_id").alias("__leak_id"), F.col("th").alias("__leak_th")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__leak_id")) & (F.xxhash64("text") == F.col("__leak_th"))
    return docs.join(bounded(leaking), same, "left_anti")
