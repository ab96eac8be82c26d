"""Removal of repeated passages by longest previous factors over suffix order, the first copy stays.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id.
The longest previous factor of a position is the longest match with an earlier document, and in suffix
order the closest positions of smaller documents, before and after, attain it. Every byte string of
``length`` bytes has one anchor, its smallest hashed ``GRAM``-gram, which depends on its bytes alone;
equal strings meet at equal anchors. So the suffixes are dealt out by anchor, sorted per anchor, and
those whose previous factor reaches ``length`` are covered.

Three passes over text, each document's bytes staying in their task: anchors of all documents, packed
by hash range, show which anchors two documents share; contexts of shared anchors are sorted in suffix
order; covered starts go back to their documents. Exact copies of a text drop out first: they are
covered whole. Within a task only the first document of equal contexts sends them on, and an anchor
with too many contexts left is split into its single strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseline.llm.common import whole, written

LENGTH = 50
GRAM = 16
#: Bytes of text per range of anchor hashes, and the fewest and most ranges; each range is sorted by one task.
RANGE_BYTES = 8 << 20
MIN_RANGES, MAX_RANGES = 64, 200_000
#: Anchors that a task gathers before it packs them by range.
PACKED_ANCHORS = 2 << 20
#: Bytes of contexts that a task gathers before it packs them by unit, and what Python holds besides per context.
PACKED_BYTES = 32 << 20
HELD_BYTES = 400
#: Parts of a unit, by more bits of the anchor's hash; they are sorted one after another.
PARTS = 16
#: Strings whose bytes are sorted at once; a part with more is sorted in slices of the suffix order.
SORTED_STRINGS = 400_000
#: Neighbours in suffix order whose common prefixes are taken at once.
COMPARED_STRINGS = 1 << 16
#: An anchor of more documents than this, and than a sixteenth of its range, is split.
HOT_ROWS = 500
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _FACTOR
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _grams(data: np.ndarray) -> np.ndarray:
    """Hashes of the ``GRAM`` bytes from every position: two 8-byte words, mixed."""
    n = len(data) - GRAM + 1
    low = np.ndarray((n + 8,), np.uint64, data.tobytes(), strides=(1,))
    return _mixed(_mixed(low[:n].copy()) + low[8 : n + 8])


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, anchor) of every ``length``-byte string: the place of its smallest gram, the first of equals."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = _grams(data)
    width = length - GRAM + 1
    # the place goes into the low bits, so that one minimum finds both, first place first
    span = 1
    n = len(h)
    best = h.copy()
    where = np.arange(n)
    while span * 2 <= width:
        left, right = best[: n - span], best[span:]
        take = right < left
        new = np.where(take, right, left)
        where = np.where(take, where[span:], where[: n - span])
        best, n, span = new, n - span, span * 2
    rest = width - span
    if rest:
        take = best[rest:] < best[: n - rest]
        where = np.where(take, where[rest:], where[: n - rest])
    return where, h


def _unique_anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of anchors, their hashes, and the first and last start of the strings each belongs to."""
    where, h = anchors(data, length)
    if not len(where):
        return where, h, where, where
    cuts = np.flatnonzero(where[1:] != where[:-1]) + 1
    first = np.r_[0, cuts]
    last = np.r_[cuts, len(where)] - 1
    places = where[first]
    return places, h[places], first, last


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    """The range that each hash is counted in."""
    return ((h >> np.uint64(44)) * np.uint64(ranges) >> np.uint64(20)).astype(np.int64)


def _in_range(home: np.ndarray | int, low: np.ndarray) -> np.ndarray:
    """Range and low 32 bits of hashes as one number, by which an anchor is counted and looked up."""
    return (np.asarray(home, np.uint64) << np.uint64(32)) | low.astype(np.uint64)


def _sent(batches: Iterator[pd.DataFrame], length: int, ranges: int) -> Iterator[pd.DataFrame]:
    """Packed (document, hash) of the anchors per range, gathered over batches until they are worth a row."""
    hashes: list[np.ndarray] = []
    keys: list[int] = []
    held = 0

    def packed() -> pd.DataFrame:
        h = np.concatenate(hashes)
        d = np.repeat(np.arange(len(keys), dtype=np.uint32), [len(x) for x in hashes])
        home = _range_of(h, ranges)
        order = np.argsort(home, kind="stable")
        h, d, home = h[order].astype(np.uint32), d[order], home[order]
        first = np.flatnonzero(np.r_[True, home[1:] != home[:-1]]) if len(h) else np.empty(0, np.int64)
        all_keys, out = np.array(keys, np.int64), []
        for a, b in zip(first, np.r_[first[1:], len(h)]):
            used, count = np.unique(d[a:b], return_counts=True)
            out.append((int(home[a]), all_keys[used].tobytes(), count.astype(np.uint32).tobytes(), h[a:b].tobytes()))
        return pd.DataFrame(out, columns=["range", "keys", "counts", "hashes"])

    for batch in batches:
        for key, text in zip(batch["key"], batch["text"]):
            _, h, _, _ = _unique_anchors(np.frombuffer(text.encode(), np.uint8), length)
            hashes.append(np.unique(h))
            keys.append(key)
            held += len(hashes[-1])
            if held > PACKED_ANCHORS:
                yield packed()
                hashes, keys, held = [], [], 0
    if hashes:
        yield packed()


def _runs(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
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


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per document: the anchors of this range that another document has too, and those of them that are hot.

    Both carry their range: low bits that are hot in one range say nothing of another.
    """
    for g in _runs(batches, "range"):
        home = int(g["range"].iloc[0])
        keys, hashes = [], []
        for k, count, h in zip(g["keys"], g["counts"], g["hashes"]):
            keys.append(np.repeat(np.frombuffer(k, np.int64), np.frombuffer(count, np.uint32)))
            hashes.append(np.frombuffer(h, np.uint32))
        k, h = np.concatenate(keys), np.concatenate(hashes)
        order = np.argsort(h, kind="stable")
        k, h = k[order], h[order]
        new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        size = np.diff(np.r_[new, len(h)])
        size = np.repeat(size, size)
        k, h, hot = k[size > 1], h[size > 1], size[size > 1] > max(HOT_ROWS, len(h) // 16)
        order = np.argsort(k, kind="stable")
        k, h, hot = k[order], _in_range(home, h[order]), hot[order]
        if len(k):
            a = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            b = np.r_[a[1:], len(k)]
            yield pd.DataFrame(
                {"key": k[a], "hashes": [h[x:y].tobytes() for x, y in zip(a, b)], "hot": [h[x:y][hot[x:y]].tobytes() for x, y in zip(a, b)]}
            )


class _Pack:
    """Contexts by part, gathered until they are worth a row per unit; of equal ones only the first document's goes out whole."""

    def __init__(self, units: int):
        self.units, self.best, self.known, self.rest, self.size = units, {}, [], [], 0

    def add(self, unit: int, key: int, order: int, start: int, strings: int, data: bytes) -> None:
        self.size += len(data) + HELD_BYTES
        old = self.best.get(data)
        if old is None or order < old[2]:
            self.best[data] = (unit, key, order, start, strings)
            if old is not None:
                self.known.append(old)
        elif order > old[2]:
            self.known.append((unit, key, order, start, strings))
        else:
            self.rest.append((unit, key, order, start, strings, data))

    def rows(self) -> pd.DataFrame:
        whole = [(*v, data) for data, v in self.best.items()] + self.rest
        bodies = [x[5] for x in whole] + [b""] * len(self.known)
        every = [x[:5] for x in whole] + [(k[1] % self.units * PARTS, *k[1:]) for k in self.known]
        table = np.array(every, np.int64).reshape(-1, 5)
        full = np.r_[np.ones(len(whole), bool), np.zeros(len(self.known), bool)]
        order = np.lexsort((table[:, 3], table[:, 1], table[:, 0]))
        table, full = table[order], full[order]
        unit = table[:, 0] // PARTS
        first = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]]) if len(table) else []
        squeeze, out = zstandard.ZstdCompressor(level=1), []
        for a, b in zip(first, np.r_[first[1:], len(table)] if len(table) else []):
            part = table[a:b]
            raw = part.T.tobytes() + np.packbits(full[a:b]).tobytes() + b"".join(bodies[i] for i in order[a:b])
            out.append((int(unit[a]), b - a, squeeze.compress(raw)))
        self.__init__(self.units)
        return pd.DataFrame(out, columns=["unit", "n", "pack"])


def _unpacked(n: int, pack: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(pack)
    flags = np.unpackbits(np.frombuffer(raw, np.uint8, -(-n // 8), 40 * n), count=n).astype(bool)
    return np.frombuffer(raw, np.int64, 5 * n).reshape(5, n), flags, raw[40 * n + -(-n // 8) :]


def _contexts(batches: Iterator[pd.DataFrame], length: int, units: int, ranges: int) -> Iterator[pd.DataFrame]:
    """Shared anchors with the bytes of the strings that they are the anchors of, dealt to units by anchor;
    the strings of hot anchors one by one, dealt by their own bytes."""
    pack = _Pack(units)
    for batch in batches:
        for key, order, text, shared, hot in zip(batch["key"], batch["doc_order"], batch["text"], batch["hashes"], batch["hot"]):
            data = text.encode()
            _, h, first, last = _unique_anchors(np.frombuffer(data, np.uint8), length)
            code = _in_range(_range_of(h, ranges), h.astype(np.uint32))
            held = np.isin(code, np.frombuffer(b"".join(shared), np.uint64))
            single = np.isin(code[held], np.frombuffer(b"".join(hot), np.uint64))
            home = (_mixed(h[held]) % np.uint64(units * PARTS)).astype(np.int64)
            for unit, lo, hi, split in zip(home.tolist(), first[held].tolist(), last[held].tolist(), single.tolist()):
                if split:
                    for at in range(lo, hi + 1):
                        string = data[at : at + length]
                        pack.add(xxhash.xxh64_intdigest(string) % (units * PARTS), key, order, at, 1, string)
                else:
                    pack.add(unit, key, order, lo, hi - lo + 1, data[lo : hi + length])
            if pack.size > PACKED_BYTES:
                yield pack.rows()
    yield pack.rows()


def _covered(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Suffix order of the strings of each unit, part by part; those whose previous factor has the length are covered."""
    for g in _runs(batches, "unit"):
        packs = [_unpacked(n, pack) for n, pack in zip(g["n"], g["pack"])]
        # what lost to an equal context within its pack is covered as it stands
        runs = [table[[1, 3, 4]][:, ~full] for table, full, _ in packs]
        places = [np.r_[0, np.cumsum(np.where(full, table[4] + length - 1, 0))] for table, full, _ in packs]
        for part in np.unique(np.concatenate([table[0][full] for table, full, _ in packs])):
            tables, bodies = [], []
            for (table, full, data), at in zip(packs, places):
                a, b = np.searchsorted(table[0], [part, part + 1])
                tables.append(table[1:, a:b][:, full[a:b]])
                bodies.append(data[at[a] : at[b]])
            runs.append(_hits(np.concatenate(tables, axis=1), b"".join(bodies), length))
        yield from _by_document(np.concatenate(runs, axis=1))


def _hits(table: np.ndarray, data: bytes, length: int) -> np.ndarray:
    """Runs (key, first, number) of covered starts among contexts (key, order, start, strings) and their bytes."""
    keys, starts = _each(table[0], table[2], table[3])
    docs, _ = _each(table[1], table[2], table[3])
    sizes = table[3] + length - 1
    at, _ = _each(np.cumsum(sizes) - sizes, np.zeros(len(sizes), np.int64), table[3], walk=True)
    hits = []
    for part in _slices(data, at):
        part = part[np.argsort(docs[part], kind="stable")]  # equal strings follow each other by document
        suffixes = np.ndarray((len(data) - length + 1,), f"S{length}", data, strides=(1,))[at[part]]
        order = np.argsort(suffixes, kind="stable")
        factors = previous_factors(suffixes[order], docs[part][order], length)
        hits.append(part[order[factors >= length]])
    hit = np.concatenate(hits)
    if not len(hit):
        return np.empty((3, 0), np.int64)
    keys, starts = keys[hit], starts[hit]
    by = np.lexsort((starts, keys))
    keys, starts = keys[by], starts[by]
    run = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (starts[1:] != starts[:-1] + 1)])
    return np.stack([keys[run], starts[run], np.diff(np.r_[run, len(keys)])])


def previous_factors(ranked: np.ndarray, docs: np.ndarray, least: int = 1) -> np.ndarray:
    """Longest previous factors of strings of one width in suffix order: the longest prefix that each shares
    with a string of a smaller document. Factors below ``least`` come as 0.

    The closest places of smaller documents, before and after, attain it. Both are searched for all places
    at once: a place points to its neighbour and jumps over larger documents by their own pointers, with
    the least common prefix on the way; it gives up when that falls below ``least``.
    """
    width = ranked.dtype.itemsize
    signs = ranked.view(np.uint8).reshape(-1, width)
    common = np.zeros(len(ranked) + 1, np.int32)  # of places i - 1 and i
    for i in range(1, len(ranked), COMPARED_STRINGS):
        differ = signs[i : i + COMPARED_STRINGS] != signs[i - 1 : i - 1 + COMPARED_STRINGS][: len(signs) - i]
        common[i : i + len(differ)] = np.where(differ.any(1), differ.argmax(1), width)
    before = _closest_smaller(docs, common[:-1], least)
    after = _closest_smaller(docs[::-1], common[:0:-1], least)[::-1]
    return np.maximum(before, after)


def _closest_smaller(docs: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """Prefix shared with the closest place before that has a smaller document; 0 if none shares ``least``."""
    shared, to = common.copy(), np.arange(-1, len(docs) - 1)
    shared[shared < least] = 0
    going = np.flatnonzero(shared)
    while True:
        going = going[docs[to[going]] >= docs[going]]
        if not len(going):
            return shared
        over = to[going]
        shared[going] = np.minimum(shared[going], shared[over])
        to[going] = to[over]
        shared[going[to[going] < 0]] = 0
        going = going[shared[going] > 0]


def _slices(data: bytes, at: np.ndarray) -> Iterator[np.ndarray]:
    """Strings at ``at`` as consecutive slices of their order, cut where the first eight bytes change."""
    if len(at) <= SORTED_STRINGS:
        yield np.arange(len(at))
        return
    lead = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))[at].astype(np.uint64)
    order = np.argsort(lead, kind="stable")
    lead = lead[order]
    new = np.flatnonzero(np.r_[True, lead[1:] != lead[:-1]])
    start = 0
    while start < len(at):
        cut = np.searchsorted(new, start + SORTED_STRINGS, "right") - 1
        end = int(new[cut]) if start + SORTED_STRINGS < len(at) else len(at)
        if end <= start:  # one head alone fills the slice
            end = int(new[cut + 1]) if cut + 1 < len(new) else len(at)
        yield order[start:end]
        start = end


def _each(values: np.ndarray, starts: np.ndarray, strings: np.ndarray, walk: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Values and starts of every single string; with ``walk`` the values count up along with the starts."""
    offset = np.arange(strings.sum()) - np.repeat(np.cumsum(strings) - strings, strings)
    return np.repeat(values, strings) + (offset if walk else 0), np.repeat(starts, strings) + offset


def _by_document(runs: np.ndarray) -> Iterator[pd.DataFrame]:
    """Covered starts per document, as runs of (first, number)."""
    if not runs.shape[1]:
        return
    runs = runs[:, np.lexsort((runs[1], runs[0]))]
    keys, spans = runs[0], runs[1:].T.astype(np.uint32)
    a = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    b = np.r_[a[1:], len(keys)]
    yield pd.DataFrame({"key": keys[a], "starts": [spans[x:y].tobytes() for x, y in zip(a, b)]})


def _removed(batches: Iterator[pd.DataFrame], length: int, keep_text: bool) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc_id, text, copy, starts in zip(batch["doc_id"], batch["text"], batch["copy"], batch["starts"]):
            data = np.frombuffer(text.encode(), np.uint8)
            mark = np.zeros(len(data) + 1, np.int32)
            if copy and len(data) >= length:
                mark[0], mark[-1] = 1, -1
            elif starts is not None and len(starts):
                runs = np.frombuffer(b"".join(starts), np.uint32).reshape(-1, 2).astype(np.int64)
                np.add.at(mark, runs[:, 0], 1)
                np.add.at(mark, runs[:, 0] + runs[:, 1] + length - 1, -1)
            gone = np.cumsum(mark[:-1]) > 0
            left = data[~gone].tobytes()
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            row = (doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
            out.append((*row, left) if keep_text else row)
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_text
        yield pd.DataFrame(out, columns=names)


def dedup(docs: DataFrame, length: int = LENGTH, keep_text: bool = False, ranges: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept (the bytes
    that stay, which may cut a character) if ``keep_text``.

    Null and empty texts have no bytes. Rows of one id are one document: none of them is earlier than
    another. Rows with a null id lose nothing and cause no loss. Texts shorter than ``length`` lose
    nothing. An empty table gives an empty result; other columns are ignored.
    """
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    body = docs.select(F.col("doc_id"), whole(F.col("text")).alias("text"))
    # a row is known by its id and text; rows alike in both have one key and one result
    keyed = body.withColumn("key", F.xxhash64("doc_id", "text")).withColumn("print", F.sha2("text", 256))
    long = F.octet_length("text") >= length
    firsts = (
        keyed.where(F.col("doc_id").isNotNull() & long)
        .groupBy("print").agg(F.min("doc_id").alias("first_id"))
    )
    about = written(
        keyed.where(long & F.col("doc_id").isNotNull()).select("key", "doc_id", "print").distinct().join(firsts, "print")
        .select("key", (F.col("doc_id") > F.col("first_id")).alias("copy")),
        "copies",
    )
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    ranges = ranges or min(MAX_RANGES, max(MIN_RANGES, -(-size // RANGE_BYTES)))
    owned = keyed.select("key", "doc_id", "text").join(about, "key", "left")
    singles = owned.where(F.col("copy").eqNullSafe(False)).select("key", F.col("doc_id").alias("doc_order"), "text")
    # all branches read the same columns, so that the text is shuffled once and reused
    packed = singles.mapInPandas(lambda it: _sent(it, length, ranges), "range int, keys binary, counts binary, hashes binary")
    shared = (
        packed.repartition(ranges, "range").sortWithinPartitions("range")
        .mapInPandas(_shared, "key long, hashes binary, hot binary")
        .groupBy("key").agg(F.collect_list("hashes").alias("hashes"), F.collect_list("hot").alias("hot"))  # of one document
    )
    covered = (
        singles.join(shared, "key")
        .mapInPandas(lambda it: _contexts(it, length, ranges, ranges), "unit long, n int, pack binary")
        .repartition(ranges, "unit").sortWithinPartitions("unit")
        .mapInPandas(lambda it: _covered(it, length), "key long, starts binary")
        .groupBy("key").agg(F.collect_list("starts").alias("starts"))  # of one document
    )
    final = owned.join(covered, "key", "left").select(
        "doc_id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "starts"
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    types = f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return final.mapInPandas(lambda it: _removed(it, length, keep_text), types + (", kept binary" if keep_text else ""))
