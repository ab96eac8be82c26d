"""Token ids in ORC: run-length encoded integers, row indexes and a Bloom filter on the document id.

Documents are written in ascending id order. Each file covers a range of ids, its stripes and row
groups carry the smallest and largest id, so that readers of some documents skip the rest, and readers
of all of them split by stripe.
"""

from __future__ import annotations

import json
import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from caseline.llm.common import whole, work_folder, written

END_ID = 1
#: Chunks that a task remembers with their ids.
CACHED_CHUNKS = 1_000_000
#: Lowered chunks that are cut here: visible ASCII but the apostrophe, and Latin letters; and their pieces.
SIMPLE = re.compile(r"[!-&(-~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+")
PIECES = re.compile(r"[a-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+|[0-9]|[!-/:-@\[-`{-~]+")
#: Characters of a text that part the ranges of a repeated id.
HEAD = 64
#: Number of a part, and of a file inside it, in the names of written files.
PART = r"^part-(\d+)"
PIECE = r"-c(\d+)[^-]*$"
# Fixed value: the cut of text that ``PIECES`` repeats for ASCII and Latin letters, as tokenizer files write it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ORC_OPTIONS = {
    "orc.compress": "ZSTD",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "5000",
    "orc.stripe.size": str(32 << 20),
    "orc.encoding.strategy": "SPEED",
}


def _byte_letters() -> dict[int, int]:
    """Byte-level letters: bytes with a visible Latin-1 letter stand for themselves, the others follow 255."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


def _cuts_as_here(shape: dict) -> bool:
    """Whether a tokenizer file normalises and cuts text the way ``_Encoder`` does without it.

    Its normaliser must compose, make white space one blank and lower, its cutter keep letters, single
    digits and runs of other signs apart and go on to byte letters, and nothing may be added to the ids.
    """
    steps = (shape.get("normalizer") or {}).get("normalizers") or []
    cuts = (shape.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return False
    blank, (split, letters) = steps[1], cuts
    return (
        blank["pattern"] == {"Regex": r"\s+"} and blank["content"] == " "
        and split["pattern"] == {"Regex": SPLIT} and split["behavior"] == "Removed" and split["invert"]
        and not letters["add_prefix_space"] and not letters["use_regex"]
        and not shape.get("truncation") and not shape.get("padding")
    )


class _Encoder(dict):
    """Ids of chunks, as bytes, by a tokenizer that never joins across blanks; chunks are remembered.

    The tokenizer drops white space and splits there, so a text's ids are those of its chunks in order.
    It lowers a chunk and cuts it into runs of letters, single digits and runs of other signs. Chunks of
    ASCII and Latin letters are cut here and their pieces go to the tokenizer's model alone; all other
    chunks, and those that hold an added token or an apostrophe, go through the whole tokenizer. Texts go
    through it whole where its file says that it normalises or cuts in another way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_chunk = _cuts_as_here(json.loads(self.tokenizer.to_str()))
        self.pieces = self.tokenizer.model.tokenize
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("(?i)" + "|".join(added) if added else "(?!)")
        self.letters = _byte_letters()

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return array("i", [t.id for t in self.pieces(piece)]).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        low = chunk.lower()
        if not SIMPLE.fullmatch(low) or self.added.search(chunk):
            ids = array("i", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        elif low != chunk:
            ids = self[low]
        else:
            parts = PIECES.findall(chunk)
            ids = self._piece(chunk) if len(parts) == 1 else b"".join([self[p] for p in parts])
        self[chunk] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_chunk:
            found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
            return [array("i", e.ids).tobytes() for e in found]
        if len(self) > CACHED_CHUNKS:
            self.clear()
        return [b"".join(map(self.__getitem__, t.replace("\n", " ").split(" "))) for t in texts]


def _encoder(path: str) -> _Encoder:
    """The encoder of this Python worker, which later tasks reuse with the chunks that it has learned."""
    held = sys.modules.setdefault("corpus_encoders", types.ModuleType("corpus_encoders")).__dict__
    if path not in held:
        held[path] = _Encoder(path)
    return held[path]


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID, extra: list[str] | None = None) -> DataFrame:
    """doc_id, the columns ``extra`` and ``ids``: the text's token ids with the end id."""
    extra = extra or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        end = np.array([end_id], np.int32).tobytes()
        for batch in (part for b in batches for part in (b.slice(i, 500) for i in range(0, b.num_rows, 500))):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            parts = [x + end for x in encoder.encode(texts)]
            offsets = np.zeros(len(parts) + 1, np.int32)
            np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ["doc_id", *extra]]
            yield pa.RecordBatch.from_arrays([*columns, ids], ["doc_id", *extra, "ids"])

    held = docs.select("doc_id", *extra, whole(F.col("text")).alias("text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema if f.name != "text")
    return held.mapInArrow(run, f"{types}, ids array<int>")


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> str:
    """Write doc_id and ids as ORC in ascending doc_id order; null ids come first.

    Null and empty texts are the end id alone. Repeated ids are kept, ordered by text. The files of the
    folder, by the numbers of their parts, hold the ids in order. The ranges come from a sample of
    ids and of heads of texts, so that no whole text goes to the driver.
    """
    body = docs.select("doc_id", whole(F.col("text")).alias("text"))
    ranged = body.repartitionByRange("doc_id", F.substring("text", 1, HEAD)).sortWithinPartitions("doc_id", "text")
    encoded(ranged, tokenizer, end_id).write.options(**ORC_OPTIONS).orc(folder)
    return folder


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("doc_id long, ids array<int>").orc(folder)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("ids"))
        if isinstance(ids, pa.LargeListArray) or isinstance(ids, pa.ListArray):
            flat, offsets = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
        else:
            raise TypeError(f"unexpected layout {ids.type}")
        raw = flat.astype("<u4", copy=False)
        sums = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "file", "block", "row")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
            ["doc_id", "file", "block", "row", "n_tokens", "ids_crc32"],
        )


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens and ids_crc32, read from the files alone.

    Rows of a file keep their order. Tokens are added up inside a file over its narrow rows, and files
    over one row each, by the numbers of their parts: names stop sorting where a number outgrows its digits.
    """
    rows = read_tokens(spark, folder).select(
        "doc_id",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "ids",
    )
    rows = written(
        rows.mapInArrow(_summed, "doc_id long, file string, block long, row long, n_tokens long, ids_crc32 long"), "token-index"
    )
    inside = Window.partitionBy("file").orderBy("block", "row").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    name = F.col("file")
    before = Window.orderBy(
        F.regexp_extract(name, PART, 1).try_cast("long"), F.regexp_extract(name, PIECE, 1).try_cast("long"), name
    ).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = rows.withColumn("_in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(bases, "file").select(
        "doc_id", (F.col("base") + F.col("_in")).cast("long").alias("start"), "n_tokens", "ids_crc32"
    )


def tokens_of(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` as token files in the shared folder, read them back and index them.

    Columns: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (unsigned crc32 of the
    ids as little-endian unsigned 32-bit integers). Null and empty texts have the end id alone; null ids
    come first; repeated rows are repeated; an empty table gives an empty result.
    """
    folder = work_folder(docs.sparkSession, "tokens")
    return token_index(docs.sparkSession, write_tokens(docs, folder, tokenizer, end_id))
