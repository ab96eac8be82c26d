"""Near-duplicate join on word n-grams: a MinHash LSH forest with exact verification.

Every distinct text gets one signature per tree, a sequence of MinHash labels. A tree is a trie of
signatures, kept as their order: a node is the run of signatures that share a prefix. Two texts meet in a
node of the present depth, and those that meet are compared by their exact n-gram sets. The depth starts
at whole signatures. Every pair found has a known chance to meet at its similarity, so the pairs found
tell how many there are; while too few of them meet, prefixes are shortened to the longest depth that
holds the target recall over what the found pairs stand for, and the next round takes the pairs that only
now meet. At ``prefix_length`` a pair exactly at the threshold has the target recall, and no round goes
below it. A node whose texts all met in one longer prefix isn't visited again.

How it stays bounded: copies collapse to one text before anything is paired. A bucket is cut into
blocks by the bytes of its n-gram sets, and every pair of blocks is a unit of work of its own, so a hot
bucket spreads over many tasks. A pair is compared only in the first round and tree in which it meets. Pairs
travel as bitmaps between two blocks, never as rows. The links of a unit leave it as one row per text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseline.llm.common import whole, written

NGRAM = 5
THRESHOLD = 0.8
TREES = 24
RECALL = 0.9999
MAX_PREFIX = 8
#: Classes of similarity, from the threshold to 1, in which found pairs are counted.
SIMILARITIES = 20
#: A block holds at most this many texts and about this many bytes of n-gram hashes.
BLOCK_TEXTS = 1024
BLOCK_BYTES = 8 << 20
CACHED_WORDS = 500_000


def prefix_length(threshold: float, trees: int, recall: float, longest: int = MAX_PREFIX) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with the target recall."""
    for depth in range(longest, 0, -1):
        if meets(threshold, depth, trees) >= recall:
            return depth
    raise ValueError("the target recall needs more trees")


def meets(similarity: np.ndarray | float, depth: int, trees: int) -> np.ndarray | float:
    """The chance that a pair shares the first ``depth`` labels in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def next_depth(found: list[int], depth: int, least: int, threshold: float, trees: int, recall: float) -> int | None:
    """The depth of the next round, None if the target recall holds already.

    ``found`` counts the linked pairs by class of similarity. Each stands for as many pairs as its chance to
    meet by now tells; one pair at the threshold is taken as there in any case, so that few pairs prove nothing.
    """
    classes = threshold + (1 - threshold) * np.arange(len(found)) / len(found)
    similarity, seen = np.r_[threshold, classes], np.r_[1, found]
    stands_for = seen / meets(similarity, depth, trees)
    for d in range(depth, least, -1):
        if (stands_for * meets(similarity, d, trees)).sum() >= recall * stands_for.sum():
            return d if d < depth else None
    return least if least < depth else None


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingles(text: str, n: int, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of lower-cased words; a shorter text is one n-gram."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    n = min(n, len(w))
    h = w[: len(w) - n + 1].copy()
    for i in range(1, n):
        h = h * np.uint64(0x100000001B3) + w[i : len(w) - n + 1 + i]
    return np.unique(_mixed(h))


class _Forest:
    """Signatures of sets: ``depth`` labels of 16 bits for each tree, one after another."""

    def __init__(self, trees: int, depth: int):
        rng = np.random.default_rng(20)
        self.size = trees * depth
        self.factor = rng.integers(0, 1 << 32, (self.size, 1), np.uint32) | np.uint32(1)
        self.mask = rng.integers(0, 1 << 32, (self.size, 1), np.uint32)

    def signature(self, hashes: np.ndarray) -> bytes:
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        least = np.full(self.size, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(low), 2048):
            part = low[i : i + 2048] ^ self.mask
            part *= self.factor
            np.minimum(least, part.min(axis=1), out=least)
        return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16).tobytes()


def _prefixes(signatures: np.ndarray, depth: int) -> np.ndarray:
    """Per text and tree one number for the first ``depth`` labels, from labels by (text, tree, place)."""
    key = np.zeros(signatures.shape[:2], np.uint64)
    for d in range(depth):
        key = _mixed(key * np.uint64(0x100000001B3) + signatures[:, :, d].astype(np.uint64) + np.uint64(1))
    return key


def _sketched(docs: DataFrame, n: int, trees: int, longest: int) -> DataFrame:
    """Per row: id, hash of the text, fingerprint of its n-gram set, size of the set, signatures of the trees."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, forest = _Words(), _Forest(trees, longest)
        for batch in batches:
            prints, sizes, signatures = [], [], []
            for text in batch["text"]:
                h = shingles(text, n, cache)
                prints.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                sizes.append(len(h))
                signatures.append(forest.signature(h) if len(h) else b"")
            yield pd.DataFrame({"doc_id": batch["doc_id"], "th": batch["th"], "fp": prints, "n": sizes, "sig": signatures})

    body = docs.select("doc_id", whole(F.col("text")).alias("text"), F.xxhash64("text").alias("th"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return body.mapInPandas(run, f"doc_id {id_type}, th long, fp binary, n int, sig binary")


def _groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Runs of equal ``key`` in sorted batches, each as one frame."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        values = batch[key].to_numpy()
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        for start, end in zip(np.r_[0, cuts], np.r_[cuts, len(values)]):
            part = batch.iloc[start:end]
            if held and held[-1][key].iloc[-1] != values[start]:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _meet(batches: Iterator[pd.DataFrame], trees: int, depth: int, before: int | None) -> Iterator[pd.DataFrame]:
    """Per unit: its texts and a bitmap of the pairs that meet here first, ``before`` being the depth of the last round."""
    out: list[tuple] = []
    for g in _groups(batches, "unit"):
        tree, lo, hi = int(g["tree"].iloc[0]), int(g["lo"].iloc[0]), int(g["hi"].iloc[0])
        labels = np.frombuffer(b"".join(g["sig"]), np.uint16).reshape(len(g), trees, -1)
        side = g["part"].to_numpy()
        pairs = np.triu(np.ones((len(g), len(g)), bool), 1)
        if lo != hi:
            pairs &= side[:, None] != side[None, :]
        met = [_prefixes(labels[:, :tree], depth)] + ([_prefixes(labels, before)] if before else [])
        for keys in np.concatenate(met, axis=1).T:
            pairs &= keys[:, None] != keys[None, :]
        used = np.flatnonzero(pairs.any(0) | pairs.any(1))
        if len(used):
            kept = pairs[np.ix_(used, used)]
            out.append((int(g["unit"].iloc[0]), list(g["fp"].to_numpy()[used]), np.packbits(kept).tobytes()))
        if len(out) >= 500:
            yield pd.DataFrame(out, columns=["unit", "fps", "pairs"])
            out = []
    yield pd.DataFrame(out, columns=["unit", "fps", "pairs"])


def _verify(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """Per unit: for each linked text the weight of its links, the smallest text linked to it here, and how many
    of the linked pairs that it leads fall in each class of similarity."""
    out: list[tuple] = []
    names = ["fp", "other", "links", "found"]
    for g in _groups(batches, "unit"):
        head, rows = g.iloc[0], g.iloc[1:]
        m = len(rows)
        pairs = np.unpackbits(np.frombuffer(head["payload"], np.uint8), count=m * m).reshape(m, m).astype(bool)
        sets = [np.frombuffer(p, np.uint64) for p in rows["payload"]]
        sizes = np.array([len(s) for s in sets])
        prints, weight = rows["fp"].to_numpy(), rows["copies"].to_numpy()
        links, root = np.zeros(m, np.int64), np.arange(m)
        classes = np.zeros((m, SIMILARITIES), np.int64)

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        owners = np.repeat(np.arange(m), sizes)
        every = np.concatenate(sets) if m else np.empty(0, np.uint64)
        order = np.argsort(every, kind="stable")
        ranked, owners = every[order], owners[order]
        for a in range(m):
            partners = np.flatnonzero(pairs[a])
            if not len(partners):
                continue
            if len(partners) <= 4:
                common = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for b in partners])
            else:
                left = np.searchsorted(ranked, sets[a], "left")
                width = np.searchsorted(ranked, sets[a], "right") - left
                at = np.repeat(left - np.r_[0, np.cumsum(width)[:-1]], width) + np.arange(width.sum())
                common = np.bincount(owners[at], minlength=m)[partners]
            union = sizes[a] + sizes[partners] - common
            near = common >= threshold * union - 1e-9
            linked = partners[near]
            share = (common[near] / union[near] - threshold) / (1 - threshold) * SIMILARITIES + 1e-6
            classes[a] = np.bincount(share.astype(int).clip(0, SIMILARITIES - 1), minlength=SIMILARITIES)
            links[a] += weight[linked].sum()
            links[linked] += weight[a]
            for b in linked:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
        for i in np.flatnonzero(links):
            out.append((prints[i], prints[find(i)], int(links[i]), classes[i].tolist()))
        if len(out) >= 2000:
            yield pd.DataFrame(out, columns=names)
            out = []
    yield pd.DataFrame(out, columns=names)


def components(edges: DataFrame, node: str = "fp", other: str = "other") -> DataFrame:
    """Smallest node of the connected component of every node that has an edge, as (node, root).

    Labels pass along edges and then jump to their own labels until none changes; each round is
    written, so that lineage stays short.
    """
    both = written(
        edges.select(F.col(node).alias("a"), F.col(other).alias("b"))
        .union(edges.select(F.col(other).alias("a"), F.col(node).alias("b")))
        .where(F.col("a") != F.col("b"))
        .distinct(),
        "edges",
    )
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")), "labels")
    while True:
        seen = both.join(labels.select(F.col("a").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        near = labels.join(seen, "a", "left").select(
            "a", F.col("root").alias("old"), F.least("root", F.coalesce("near", "root")).alias("mid")
        )
        jump = labels.select(F.col("a").alias("mid"), F.col("root").alias("far"))
        after = written(
            near.join(jump, "mid", "left").select("a", "old", F.least("mid", F.coalesce("far", "mid")).alias("root")),
            "labels",
        )
        labels = after.select("a", "root")
        if after.where(F.col("root") != F.col("old")).isEmpty():
            return labels.select(F.col("a").alias(node), "root")


def _nodes(texts: DataFrame, trees: int, depth: int, before: int | None) -> DataFrame:
    """The texts of every node of ``depth`` labels that holds several, but for nodes whose texts share ``before`` labels."""
    width = 2 * MAX_PREFIX

    def prefix(tree: int, labels: int) -> Column:
        return F.xxhash64(F.lit(tree), F.substring("sig", 1 + tree * width, 2 * labels))

    keys = [F.struct(prefix(t, depth).alias("key"), prefix(t, before or depth).alias("last")) for t in range(trees)]
    placed = texts.select("fp", "n", F.posexplode(F.array(*keys)).alias("tree", "at")).select("fp", "n", "tree", "at.*")
    shared = (
        placed.groupBy("key")
        .agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("total"), F.min("last").alias("a"), F.max("last").alias("b"))
        .where("c > 1" if before is None else "a <> b")
        .select("key", "c", "total")
    )
    return placed.drop("last").join(shared, "key")


def _met(texts: DataFrame, trees: int, depth: int, before: int | None) -> DataFrame:
    """The pairs that meet in this round, as bitmaps between the texts of a unit."""
    cut = F.greatest(F.ceil(F.col("c") / BLOCK_TEXTS), F.ceil(F.col("total") * 8 / BLOCK_BYTES)).cast("int")
    members = (
        _nodes(texts, trees, depth, before)
        .withColumn("parts", cut)
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "fp", "tree", "part", F.least("part", "with").alias("lo"), F.greatest("part", "with").alias("hi"), "key"
        )
        .withColumn("unit", F.xxhash64("key", "lo", "hi"))
        .drop("key")
        .join(texts.select("fp", "sig"), "fp")
    )
    return (
        members.repartition("unit")
        .sortWithinPartitions("unit")
        .mapInPandas(lambda it: _meet(it, trees, depth, before), "unit long, fps array<binary>, pairs binary")
    )


def _gram_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The n-gram sets of the texts in ``wanted`` (fp, doc_id, th, copies)."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = _Words()
        for b in batches:
            yield pd.DataFrame(
                {"fp": b["fp"], "copies": b["copies"], "payload": [shingles(t, n, cache).tobytes() for t in b["text"]]}
            )

    named = docs.select(F.col("doc_id").alias("_id"), F.col("text"), F.xxhash64("text").alias("_th"))
    found = named.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_th") == F.col("th")))
    return (
        found.select("fp", "copies", whole(F.col("text")).alias("text"))
        .mapInPandas(sets, "fp binary, copies long, payload binary")
        .dropDuplicates(["fp"])
    )


def _verified(met: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """The links among the pairs of ``met``, as one row per unit and linked text."""
    units = (
        met.select("unit", F.posexplode("fps").alias("at", "fp"))
        .join(grams, "fp")
        .select("unit", "at", "fp", "copies", "payload")
        .unionByName(
            met.select(
                "unit",
                F.lit(-1).alias("at"),
                F.lit(None).cast("binary").alias("fp"),
                F.lit(0).cast("long").alias("copies"),
                F.col("pairs").alias("payload"),
            )
        )
    )
    return (
        units.repartition("unit")
        .sortWithinPartitions("unit", "at")
        .mapInPandas(lambda it: _verify(it, threshold), "fp binary, other binary, links long, found array<long>")
    )


def near_duplicates(
    docs: DataFrame, threshold: float = THRESHOLD, n: int = NGRAM, trees: int = TREES, recall: float = RECALL
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its class and its links.

    Columns: ``doc_id``; ``th``, a hash of the text; ``class_id``, the smallest id among the rows joined
    by links; ``n_links``, the rows other than itself whose Jaccard similarity reaches ``threshold``;
    ``first``, true for the row of the class with the smallest id (ties by ``th``).

    Texts without words, null included, link to nothing and each such row forms its own class. Texts of
    fewer than ``n`` words are one n-gram. Rows with equal n-gram sets are copies and always linked.
    Null ids sort last and give a null class only among themselves. An empty table gives an empty
    result; other columns are ignored.
    """
    least = prefix_length(threshold, trees, recall)
    rows = written(_sketched(docs, n, trees, MAX_PREFIX), "sketch")
    some = rows.where("n > 0")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "th")
    texts = written(
        some.groupBy("fp").agg(
            F.min(F.struct(order.alias("at"), "n", "sig")).alias("_v"), F.count(F.lit(1)).alias("copies")
        ).select("fp", F.col("_v.at.doc_id").alias("doc_id"), F.col("_v.at.th").alias("th"), "_v.n", "_v.sig", "copies"),
        "texts",
    )
    nodes = _nodes(texts, trees, least, None)
    wanted = nodes.select("fp").distinct().join(texts, "fp").select("fp", "doc_id", "th", "copies")
    grams = written(_gram_sets(docs, wanted, n), "grams")
    depth, before, links = MAX_PREFIX, None, None
    while True:
        met = written(_met(texts, trees, depth, before), "met")
        more = written(_verified(met, grams, threshold), "links")
        links = links.unionByName(more) if links else more
        counts = links.agg(*[F.sum(F.col("found")[i]).alias(f"c{i}") for i in range(SIMILARITIES)]).first()
        before, depth = depth, next_depth([c or 0 for c in counts], depth, least, threshold, trees, recall)
        if depth is None:
            break
    roots = components(links.select("fp", "other"))
    degree = links.groupBy("fp").agg(F.sum("links").alias("links"))
    about = texts.select("fp", "doc_id", "th", "copies").join(degree, "fp", "left").join(roots, "fp", "left")
    about = about.select(
        "fp",
        F.coalesce("root", "fp").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "th").alias("at"),
    )
    classes = about.groupBy("root").agg(F.min("at").alias("least"))
    known = about.join(classes, "root").select("fp", "n_links", "least")
    linked = some.select("doc_id", "th", "fp").join(known, "fp").select(
        "doc_id",
        "th",
        F.col("least.doc_id").alias("class_id"),
        "n_links",
        (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("th") == F.col("least.th"))).alias("first"),
    )
    alone = rows.where("n = 0").select(
        "doc_id", "th", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("first")
    )
    return linked.unionByName(alone)


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of every near-duplicate class, the one with the smallest id; all its columns stay.

    Rows without words all stay, except that repeated rows (same id and text) are one row.
    """
    kept = near_duplicates(docs, **options).where("first").select(
        F.col("doc_id").alias("_kept"), F.col("th").alias("_kept_th")
    ).distinct()
    keyed = docs.withColumn("_th", F.xxhash64("text"))
    on = keyed["doc_id"].eqNullSafe(kept["_kept"]) & (keyed["_th"] == kept["_kept_th"])
    return keyed.join(kept, on, "left_semi").dropDuplicates(["doc_id", "_th"]).drop("_th")
