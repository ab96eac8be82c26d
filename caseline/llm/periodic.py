"""Periodic runs of words: stretches that repeat a shorter stretch, found by uniting suffix classes.

Suffixes of a text's words are sorted by doubling, and neighbours in suffix order are united by decreasing
longest common prefix, as Kruskal does with edges. Each class keeps its positions in order; where a union
makes two positions neighbours whose distance is within the common prefix, they seed a run. For every
maximal run its start and the place one period later do so: nothing between them shares as long a prefix,
else the period were not the smallest. So runs are found once each, from their first place, and their
ends are known from the prefix.

Every text is worked on by itself, so no rows meet and nothing is shuffled; a task holds a few texts.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from caseline.llm.common import whole

#: Fixed value: what a word is.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Words of texts whose suffixes are sorted together; a longer text is sorted alone.
BATCH_WORDS = 400_000


def _dense(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of ``values``: for each value the place of the first of its equals, and the order."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    first = np.flatnonzero(new)
    rank = np.empty(len(values), np.int64)
    rank[order] = first[np.cumsum(new) - 1]
    return rank, order


class Suffixes:
    """Suffix order of words within their texts. Suffixes of different texts never share a prefix."""

    def __init__(self, codes: np.ndarray):
        """``codes`` are numbers of (text, word) pairs, texts one after another."""
        n = len(codes)
        rank, order = _dense(codes)
        self.ranks, span = [rank], 1
        while span < n:
            ordered = rank[order]
            same = ordered[1:] == ordered[:-1]
            held = np.flatnonzero(np.r_[False, same] | np.r_[same, False])  # places of ranks that several share
            if not len(held):
                break
            at = order[held]
            behind = np.where(at + span < n, rank[np.minimum(at + span, n - 1)], -1)
            by = np.lexsort((behind, rank[at]))
            at, behind = at[by], behind[by]
            old = rank[at]
            new = np.r_[True, (old[1:] != old[:-1]) | (behind[1:] != behind[:-1])]
            order = order.copy()
            order[held] = at  # groups keep their places, as ranks are places of first members
            rank = rank.copy()
            rank[at] = held[np.flatnonzero(new)][np.cumsum(new) - 1]
            self.ranks.append(rank)
            span *= 2
        self.order = order

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common prefixes of the suffixes at ``a`` and ``b``."""
        n, length = len(self.order), np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.ranks))):
            i, j = a + length, b + length
            inside = (i < n) & (j < n)
            same = inside & (self.ranks[k][np.minimum(i, n - 1)] == self.ranks[k][np.minimum(j, n - 1)])
            length += same.astype(np.int64) << k
        return length


def _seeds(order: np.ndarray, common: np.ndarray, least: int) -> tuple[list[int], list[int], list[int]]:
    """Pairs (position, later position, prefix) that become neighbours in a class at a distance within the prefix.

    ``common`` holds the longest common prefix of each suffix in ``order`` with the one before it.
    Unions below ``least`` are left out: they seed nothing that is long enough.
    """
    parent: dict[int, int] = {}
    held: dict[int, list[int]] = {}
    firsts, seconds, lengths = [], [], []

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    edges = np.flatnonzero(common >= least)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    for left, right, length in zip(order[edges - 1].tolist(), order[edges].tolist(), common[edges].tolist()):
        a, b = find(left), find(right)
        some, many = held.pop(a, None) or [a], held.pop(b, None) or [b]
        if len(some) > len(many):
            a, b, some, many = b, a, many, some
        parent[a] = b
        # neighbours across the two sets: those of each member of the smaller one
        for i, x in enumerate(some):
            k = bisect_left(many, x)
            before = many[k - 1] if k else -1
            if i and some[i - 1] > before:
                before = -1  # the member before is nearer, and of the same set
            after = many[k] if k < len(many) else -1
            if i + 1 < len(some) and some[i + 1] < after:
                after = -1
            if before >= 0 and x - before <= length:
                firsts.append(before)
                seconds.append(x)
                lengths.append(length)
            if after >= 0 and after - x <= length:
                firsts.append(x)
                seconds.append(after)
                lengths.append(length)
        if len(some) * 16 < len(many):
            for x in some:
                many.insert(bisect_left(many, x), x)
        else:
            many = sorted(some + many)  # two ordered lists are merged in one pass
        held[b] = many
    return firsts, seconds, lengths


def runs_of(codes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of all maximal runs of at least ``min_length`` words and ``min_exponent``
    periods, by start, then period. ``codes`` as for ``Suffixes``."""
    if min_exponent < 2:
        raise ValueError("runs below two periods are not seeded")
    none = np.empty((0, 3), np.int64)
    if len(codes) < 2:
        return none
    suffixes = Suffixes(codes)
    order = suffixes.order
    common = np.r_[0, suffixes.common(order[:-1], order[1:])]
    # a run of period q shares length - q words with itself, at least this many over all q
    least = min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))
    first, second, prefix = (np.array(x, np.int64) for x in _seeds(order, common, least))
    if not len(first):
        return none
    period = second - first
    length = period + prefix
    inner = (first > 0) & (codes[first - 1] == codes[second - 1])  # the run starts before
    long = (length >= min_length) & (length >= min_exponent * period)
    found = np.stack([first, length, period], axis=1)[long & ~inner]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _per_text(batches: Iterator[pa.RecordBatch], min_length: int, min_exponent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held, size, done = [], 0, 0
        for text in batch.column("text"):
            held.append(WORD.findall(text.as_py()))
            size += len(held[-1])
            if size > BATCH_WORDS:
                yield _results(batch.column("doc_id").slice(done, len(held)), held, min_length, min_exponent)
                held, size, done = [], 0, done + len(held)
        if held:
            yield _results(batch.column("doc_id").slice(done), held, min_length, min_exponent)


def _results(ids: pa.Array, held: list[list[str]], min_length: int, min_exponent: int) -> pa.RecordBatch:
    """``held`` are the words of the texts with these ids."""
    sizes = np.array([len(words) for words in held], np.int64)
    starts = np.cumsum(sizes) - sizes
    found = np.empty((0, 3), np.int64)
    if sizes.sum():
        codes, _ = pd.factorize(np.array([w for words in held for w in words], object))
        found = runs_of(np.repeat(np.arange(len(held)), sizes) * (codes.max() + 1) + codes, min_length, min_exponent)
    ends = np.searchsorted(found[:, 0], np.r_[starts, sizes.sum()])
    runs, collapsed = [], []
    for k, words in enumerate(held):
        mine = found[ends[k] : ends[k + 1]] - [starts[k], 0, 0]
        runs.append([{"start": a, "length": b, "period": c} for a, b, c in mine.tolist()])
        if len(mine):
            mark = np.zeros(len(words) + 1, np.int64)
            np.add.at(mark, mine[:, 0] + mine[:, 2], 1)
            np.add.at(mark, mine[:, 0] + mine[:, 1], -1)
            words = [w for w, gone in zip(words, (np.cumsum(mark[:-1]) > 0).tolist()) if not gone]
        collapsed.append(" ".join(words))
    columns = [ids, pa.array(sizes), pa.array(runs, RUNS), pa.array(collapsed, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``n_words``, ``runs`` and ``collapsed``.

    A run is a stretch of words with smallest period q, of at least ``min_length`` words and
    ``min_exponent`` periods, that no neighbouring word extends; ``runs`` lists (start, length, period) by
    start, then period. ``collapsed`` holds the words, joined by one space, without those that a run
    contains after its first period. Null and empty texts have no words. Repeated rows and rows of a
    null id each have their own result; other columns are ignored.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    body = docs.select("doc_id", whole(docs["text"]).alias("text"))
    return body.mapInArrow(
        lambda it: _per_text(it, min_length, min_exponent),
        f"doc_id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )
