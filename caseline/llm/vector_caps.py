"""Near duplicates among vectors, by spherical-cap filters.

Filters are directions on the sphere with a common threshold. The directions form a structured random
product code: a random rotation, then the coordinates in blocks, each with its own code of random unit
vectors; a filter takes one code word of every block. So a code of few words names very many filters, and a
vector's list, all filters whose cap holds it, is decoded block by block: partial sums that can't reach the
threshold any more go at once.

Vectors join on filters of equal label. The code grows with the table, so that a filter seldom holds two
unrelated vectors; filters with one vector are dropped by their count before any vector moves.
The pairs that meet are verified by their cosine in double precision. A pair that meets in several filters
counts in the first of them. Copies of one vector are one member with a weight. A filter that very many
vectors share is cut into blocks, each pair of blocks is a unit of work, and a unit hands on counts and a
spanning forest of its links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseline.llm.common import written
from caseline.llm.ngram_join import components

THRESHOLD = 0.98
#: Product codes, each with a rotation of its own; several even out how many filters a vector lies in.
CODES = 16
#: Words per block that a code has at most, before it gets another block.
MOST_WORDS = 1024
#: Unrelated vectors of its label that a filter holds on average.
UNRELATED = 0.03
#: All but a tenth of the vectors lie in so many filters at least.
LISTED = 6
#: The cap's threshold is fitted on so many vectors at most, the ones of smallest hash.
SAMPLE = 500
SEED = 11
#: Vectors of a filter that one unit of work compares with another block.
BLOCK_VECTORS = 512
#: Members up to which the pairs of many filters are verified together.
FEW = 16
#: Vectors that are decoded together, and earlier filters that are looked up together.
DECODED, LOOKED_UP = 512, 2048


class Code:
    """A product code for vectors of ``d`` coordinates: rotation, block bounds and ``words`` unit vectors per block."""

    def __init__(self, d: int, words: int, blocks: int, seed: int):
        rng = np.random.default_rng([SEED, seed, d, words])
        self.rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
        blocks = min(blocks, d)
        self.bounds = np.linspace(0, d, blocks + 1).astype(int)
        self.words = words
        self.books = []
        for a, b in zip(self.bounds[:-1], self.bounds[1:]):
            book = rng.standard_normal((b - a, words))
            self.books.append(book / np.linalg.norm(book, axis=0) / np.sqrt(blocks))

    def decode(self, unit: np.ndarray, cap: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, filter, product) of all filters whose product with a row of unit vectors reaches ``cap``."""
        turned = unit @ self.rotation
        parts = [turned[:, a:b] @ book for (a, b), book in zip(zip(self.bounds[:-1], self.bounds[1:]), self.books)]
        tops = np.stack([p.max(axis=1) for p in parts])
        ahead = np.cumsum(tops[::-1], axis=0)[::-1]  # what this block and the later ones can add at most
        row, code, total = np.arange(len(unit)), np.zeros(len(unit), np.int64), np.zeros(len(unit))
        for k, part in enumerate(parts):
            rest = ahead[k + 1] if k + 1 < len(parts) else np.zeros(len(unit))
            most = ahead[0] - ahead[k] if k else np.zeros(len(unit))
            # words that can't reach the cap even with the best of all other blocks
            usable = part >= (cap - rest - most)[:, None]
            count = usable.sum(axis=1)
            word = np.nonzero(usable)[1]
            start = np.cumsum(count) - count
            times = count[row]
            at = np.repeat(np.arange(len(row)), times)
            within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            chosen = word[start[row[at]] + within]
            sums = total[at] + part[row[at], chosen]
            keep = sums >= cap - rest[row[at]]
            row, code, total = row[at][keep], code[at][keep] * self.words + chosen[keep], sums[keep]
        return row, code, total


def units_of(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, whatever their size."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def code_size(n: int, unrelated: float = UNRELATED) -> tuple[int, int]:
    """(words, blocks) of a code, so that each of its filters holds ``unrelated`` of ``n`` vectors if every
    vector lies in one filter."""
    blocks = 2
    while (words := int(np.ceil((max(n, 1) / unrelated) ** (1 / blocks)))) > MOST_WORDS:
        blocks += 1
    return max(2, words), blocks


class Filters:
    """All codes for vectors of one length, with their common threshold."""

    def __init__(self, d: int, words: int, blocks: int, cap: float | None, codes: int = CODES):
        self.codes = [Code(d, words, blocks, seed) for seed in range(codes)]
        self.span = words ** len(self.codes[0].books)
        if cap is None:  # of a length that the sample lacks
            self.cap = self.fitted(np.random.default_rng([SEED, d]).standard_normal((SAMPLE, d)))
        else:
            self.cap = cap

    def lists(self, unit: np.ndarray, cap: float | None = None) -> list[np.ndarray]:
        """Sorted filters of every row of unit vectors."""
        rows, filters = [], []
        for start in range(0, len(unit), DECODED):
            for k, code in enumerate(self.codes):
                row, found, _ = code.decode(unit[start : start + DECODED], self.cap if cap is None else cap)
                rows.append(row + start)
                filters.append(found + k * self.span)
        row, found = np.concatenate(rows), np.concatenate(filters)
        order = np.lexsort((found, row))
        return np.split(found[order], np.searchsorted(row[order], np.arange(1, len(unit))))

    def fitted(self, sample: np.ndarray) -> float:
        """The largest threshold, in steps of 0.005, at which all but a tenth of the sample lie in ``LISTED`` filters.

        A hot group can't move it while it holds less than nine tenths.
        """
        unit = units_of(sample)

        def enough(cap: float) -> bool:
            sizes = np.zeros(len(unit), np.int64)
            for start in range(0, len(unit), DECODED):
                for code in self.codes:
                    row, _, _ = code.decode(unit[start : start + DECODED], cap)
                    sizes += np.bincount(row + start, minlength=len(unit))
            return np.quantile(sizes, 0.1, method="lower") >= LISTED

        # from above, as lists are short there
        coarse = next((c for c in range(19, -20, -1) if enough(c / 20)), -20)
        return next(c / 200 for c in range(10 * coarse + 9, 10 * coarse - 1, -1) if c == 10 * coarse or enough(c / 200))


def _usable(embedding: Column) -> Column:
    """Whether a vector has a direction: components all known and finite, not all zero."""
    known = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(embedding.isNotNull() & known & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _listed(batches: Iterator[pd.DataFrame], words: int, blocks: int, caps: dict[int, float], codes: int) -> Iterator[pd.DataFrame]:
    ready: dict[int, Filters] = {}
    for batch in batches:
        lengths = batch["embedding"].map(len).to_numpy()
        lists = np.empty(len(batch), object)
        for d in np.unique(lengths).tolist():
            if d not in ready:
                ready[d] = Filters(d, words, blocks, caps.get(d), codes)
            at = np.flatnonzero(lengths == d)
            for i, found in zip(at, ready[d].lists(units_of(np.stack(batch["embedding"].iloc[at])))):
                lists[i] = found
        yield batch.drop(columns="embedding").assign(d=lengths, filters=lists)


KEY = ["label", "d", "filter", "lo", "hi"]


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches cut so that no unit of work is in two of them, with ``unit`` numbering the units of a batch."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        both = pd.concat([*held, batch], ignore_index=True) if held else batch.reset_index(drop=True)
        keys = both[KEY]
        both["unit"] = (keys != keys.shift()).any(axis=1).cumsum()
        last = both["unit"].iloc[-1]
        ready = both[both["unit"] != last]
        if len(ready):
            yield ready
        held = [both[both["unit"] == last].drop(columns="unit")]
    if held:
        yield pd.concat(held, ignore_index=True).assign(unit=0)


def _linked(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """(node, other, links): links of a node that count here, and another node of its component."""
    for batch in _groups(batches):
        size = batch.groupby("unit")["unit"].transform("size")
        few = batch[(size <= FEW) & (batch["parts"] == 1)]
        if len(few):
            yield _few(few, threshold)
        for _, unit in batch.drop(few.index).groupby("unit"):
            yield _block(unit, threshold)


def _few(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """The pairs of many small filters at once, by their distance in the order of rows."""
    unit, nodes, copies = rows["unit"].to_numpy(), rows["node"].to_numpy(), rows["copies"].to_numpy()
    filters, at = rows["filters"].to_numpy(), rows["filter"].to_numpy()
    lengths = rows["d"].to_numpy()
    vectors = np.empty(len(rows), object)
    for d in np.unique(lengths):
        for i, v in zip(np.flatnonzero(lengths == d), units_of(np.stack(rows["embedding"].to_numpy()[lengths == d]))):
            vectors[i] = v
    out = []
    for step in range(1, FEW):
        first = np.flatnonzero(unit[step:] == unit[:-step]) if len(unit) > step else []
        if not len(first):
            break
        for a in first:
            b = a + step
            if vectors[a] @ vectors[b] >= threshold:
                counts = np.intersect1d(filters[a], filters[b], assume_unique=True)[0] == at[a]
                out += [(nodes[a], nodes[b], int(copies[b]) * counts), (nodes[b], nodes[a], int(copies[a]) * counts)]
    return pd.DataFrame(out, columns=["node", "other", "links"])


def _block(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """One unit: all its vectors with each other, or those of one block with those of another."""
    vectors = units_of(np.stack(rows["embedding"].to_numpy()))
    lo, hi = int(rows["lo"].iloc[0]), int(rows["hi"].iloc[0])
    part, filters = rows["part"].to_numpy(), rows["filters"].to_numpy()
    linked = vectors @ vectors.T >= threshold
    if lo == hi:
        np.fill_diagonal(linked, False)
    else:
        linked &= part[:, None] != part[None, :]
    # a pair counts in the first filter that both lie in
    here = rows["filter"].iloc[0]
    earlier = [f[f < here] for f in filters]
    every, seen = np.unique(np.concatenate(earlier), return_counts=True)
    every, counted = every[seen > 1], linked.copy()
    for start in range(0, len(every), LOOKED_UP):
        some = every[start : start + LOOKED_UP]
        holds = np.zeros((len(rows), len(some)), np.float32)
        for i, f in enumerate(earlier):
            place = np.searchsorted(some, f)
            inside = place < len(some)
            place = place[inside]
            holds[i, place[some[place] == f[inside]]] = 1
        counted &= (holds @ holds.T) == 0
    links = counted @ rows["copies"].to_numpy(np.int64)
    # the smallest place that each reaches: a spanning forest instead of all pairs
    root = np.arange(len(rows))
    while True:
        near = np.minimum(root, np.where(linked, root[None, :], len(rows)).min(axis=1))
        near = near[near]
        if (near == root).all():
            break
        root = near
    nodes = rows["node"].to_numpy()
    some = linked.any(axis=1)
    return pd.DataFrame({"node": nodes[some], "other": nodes[root[some]], "links": links[some]})


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, codes: int = CODES, unrelated: float = UNRELATED
) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): ``n_links``, ``component_id`` and ``kept``.

    Rows of equal label and vector length are linked if their cosine reaches ``threshold``; the search
    finds nearly all such pairs and no other. ``n_links`` counts the other rows linked directly, repeated rows
    among them; ``component_id`` is the smallest id that links lead to, and the row that has it is kept.
    Null labels, and vectors that are null, empty, zero or hold a null or non-finite component, link with
    nothing. Null ids count as rows but are never the smallest, unless a component has no other; then all
    its rows are kept, as are all rows of the smallest id. An empty table gives an empty result; other
    columns are ignored.
    """
    embedding = F.col("embedding")
    usable = F.col("label").isNotNull() & _usable(embedding)
    key = F.concat_ws(":", F.col("label").cast("string"), *[F.xxhash64(F.lit(k), "label", embedding) for k in (1, 2)])
    rows = vectors.select("vec_id", "label", embedding, F.when(usable, F.unhex(F.md5(key))).alias("node"))
    found = rows.where(F.col("node").isNotNull())
    most = found.groupBy("label", F.size("embedding")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    words, blocks = code_size(most or 0, unrelated)
    sample = found.orderBy(F.xxhash64("node", "vec_id")).limit(SAMPLE).select(F.size("embedding").alias("d"), "embedding").toPandas()
    caps = {
        int(d): Filters(int(d), words, blocks, 0.0, codes).fitted(np.stack(some["embedding"].to_numpy()))
        for d, some in sample.groupby("d")
        if len(some) >= SAMPLE // 20
    }
    label_type = vectors.schema["label"].dataType.simpleString()
    listed = found.select("node", "label", "embedding").mapInPandas(
        lambda it: _listed(it, words, blocks, caps, codes), f"node binary, label {label_type}, d int, filters array<long>"
    )
    # lists and ids only: vectors stay where they are until a filter is shared
    nodes = written(
        listed.groupBy("node").agg(
            F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("d").alias("d"), F.first("filters").alias("filters")
        ),
        "caps",
    )
    entries = nodes.select("node", "copies", "label", "d", F.explode("filters").alias("filter"))
    bucket = ["label", "d", "filter"]
    shared = entries.groupBy(*bucket).agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    parts = F.ceil(F.col("held") / BLOCK_VECTORS).cast("int")
    members = (  # a node's filters are a short list, however many share them
        entries.join(shared, bucket).groupBy("node").agg(
            F.first("copies").alias("copies"),
            F.first("label").alias("label"),
            F.first("d").alias("d"),
            F.array_sort(F.collect_list(F.struct("filter", parts.alias("parts")))).alias("held"),
        )
    )
    carried = found.join(members.select("node"), "node", "left_semi").groupBy("node").agg(F.first("embedding").alias("embedding"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    work = (
        members.join(carried, "node")
        .select("node", "copies", "label", "d", "embedding", F.col("held.filter").alias("filters"), F.inline("held"))
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("with", other)
        .withColumns({"lo": F.least("part", "with"), "hi": F.greatest("part", "with")})
        .drop("with")
    )
    links = written(
        work.repartition(*KEY).sortWithinPartitions(*KEY)
        .mapInPandas(lambda it: _linked(it, threshold), "node binary, other binary, links long"),
        "links",
    )
    reached = components(links.select("node", "other"), "node", "other")
    degree = links.groupBy("node").agg(F.sum("links").alias("links"))
    least = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("vec_id").alias("least"))
    about = written(
        nodes.select("node", "copies").join(least, "node").join(degree, "node", "left").join(reached, "node", "left").select(
            "node",
            F.coalesce("root", "node").alias("root"),
            "least",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "about",
    )
    classes = about.groupBy("root").agg(F.min("least").alias("component_id"))
    known = about.join(classes, "root").select("node", "n_links", "component_id")
    together = rows.select("vec_id", "node").join(known, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return together.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
