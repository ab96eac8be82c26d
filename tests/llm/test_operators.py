"""Every corpus operator against a brute-force version on small tables with nulls, empty and repeated rows."""

from __future__ import annotations

import hashlib
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import regex
from pyarrow import orc
from pyspark.sql import functions as F

from caseline.llm import chat, decontaminate, license_scan, mixing, ngram_join, pii, quality_rules, suffix_dedup, token_files, warc
from caseline.llm.oracles import ORACLES
from caseline.llm.queries import MIX_WEIGHTS, tokenizer_path
from compare import difference

PROSE = "the quick brown fox jumps over the lazy dog while seven wise men watch from a small green hill near town and say nothing at all"
LONG = " ".join(f"word{i % 977}x{i // 977}" for i in range(6000))
TEXTS = [
    None,
    "",
    " \n\t ",
    PROSE,
    PROSE,
    PROSE.replace("lazy", "sleepy"),
    PROSE + "\n" + PROSE + "\n" + PROSE,
    "one two three",
    "one two three",
    "Licensed under CC BY-NC 4.0.\nall rights reserved, ALL RIGHTS RESERVED",
    "Released under the MIT License.\nGNU general-public license",
    "mail bob.smith_1@mail.example.org or +1 (555) 123-4567, host 10.0.0.255 and 10.0.0.256, card 4111 1111 1111 1111",
    "4111111111111112 is no card; a@b.c_d@e.f; 1.2.3.4.5.6.7.8; 000000000001.2.3.4",
    "é ü ß 中文 \U0001f600 x@y.zz 中 +12 345 678 90",
    LONG,
    LONG + " tail " + PROSE,
    "### $$$ *** %%% &&& ||| " * 10,
    "x" * 300,
    "x" * 300 + "y",
    "A" * 49,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 7 else None, t, None if i == 3 else f"src{i % 3}", 1, "clash") for i, t in enumerate(TEXTS)]
    rows += [(3, PROSE, "src0", 2, "clash"), (3, "the same id with another text " + PROSE, "src1", 2, "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, key int, n_words string")


def result(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_quality(docs):
    def brute(text):
        words = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed)

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    out = quality_rules.quality(docs)
    assert result(out, *names) == sorted(((i, *brute(t)) for i, t in rows_of(docs)), key=repr)
    kept = {r["doc_id"]: r["kept"] for r in out.collect()}
    assert kept[5] and kept[14] and not kept[16] and not kept[0]
    rules = quality_rules.default_rules()
    measured = quality_rules.measures(docs)
    backwards = measured.select("doc_id", quality_rules.cascade(rules[::-1]).alias("kept"))
    assert result(backwards, "doc_id", "kept") == result(out, "doc_id", "kept")


def test_quality_rules_at_any_length_and_script(spark):
    rng = np.random.default_rng(3)
    vocabulary = np.array([f"word{i}" for i in range(400)])
    acronyms = "Доклад о работе НАТО и сети TCP/IP " * 2
    russian = " ".join(f"строка{chr(0x430 + i % 32)} слово{chr(0x430 + i // 3)} тест" for i in range(60)) + " NATO UNESCO HTTP JSON SQL CPU RAM USB DVD XML HTML CSS API"
    texts = {
        1: " ".join(vocabulary[rng.integers(0, 400, 200_000)]),  # 0.2 % distinct words, none frequent
        2: " ".join(f"spam other{i}" if i % 9 else "spam spam" for i in range(300)),  # one word of over half, the others vary
        3: " ".join(f"half other{i}" for i in range(300)),  # exactly half
        4: acronyms + russian,
        5: " ".join(f"ГРОМКО{chr(0x410 + i % 32)} КРИК{chr(0x410 + i // 3)}" for i in range(60)),
        6: " ".join(f"LOUD{chr(65 + i % 26)} CRY{chr(65 + i // 3)}" for i in range(60)),
    }
    made = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = dict(result(quality_rules.quality(made), "doc_id", "kept"))
    assert kept == {1: True, 2: False, 3: True, 4: True, 5: False, 6: False}
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([(i, t) for i, t in texts.items() if i > 1], columns=["doc_id", "text"]))  # the SQL is quadratic in words
    made = made.where("doc_id > 1")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert difference(quality_rules.quality(made).select(*names, "kept"), con, ORACLES["op2_quality_rules"]) is None


def test_quality_order(spark):
    rows = spark.range(100).select("id", F.lit("t").alias("text"))
    cheap = quality_rules.Rule("cheap", F.col("id") < 10, F.lit(1))
    strong = quality_rules.Rule("strong", F.col("id") < 90, F.lit(2))
    dear = quality_rules.Rule("dear", F.col("id") < 91, F.lit(1000))
    assert [r.name for r in quality_rules.ordered(rows, [dear, cheap, strong])] == ["strong", "dear", "cheap"]


def test_quality_sample(spark):
    rows = spark.range(50_000, numPartitions=40).select(F.col("id").alias("_m"), F.lit(PROSE).alias("text"), F.col("id").alias("r0"))
    found = quality_rules.sampled(rows, 2000)
    assert 1700 < found.count() < 2300 and found.where("_m >= 25000").count() > 700
    assert "Limit" not in found._jdf.queryExecution().executedPlan().toString()
    assert quality_rules.sampled(rows, 50_000).count() == 50_000
    out = quality_rules.quality(rows.limit(10))
    assert set(rows.columns) < set(out.columns) and out.where("kept").count() == 10


def test_suffix_dedup(docs, spark):
    rows = [(i, t, (t or "").encode()) for i, t in rows_of(docs)]
    rows += [(100 + k, None, (PROSE[k:] + str(k) * 60 + PROSE).encode()) for k in range(5)]
    more = spark.createDataFrame([(100 + k, PROSE[k:] + str(k) * 60 + PROSE) for k in range(5)], "doc_id long, text string")
    first = {}
    for i, _, b in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], i)
    expected = []
    for i, _, b in rows:
        mark = bytearray(len(b))
        for k in range(len(b) - 49):
            if i is not None and first[b[k : k + 50]] < i:
                mark[k : k + 50] = b"\1" * 50
        left = bytes(x for x, m in zip(b, mark) if not m)
        spans = sum(m and not (k and mark[k - 1]) for k, m in enumerate(mark))
        expected.append((i, len(b), sum(mark), spans, hashlib.sha256(left).hexdigest()))
    both = docs.select("doc_id", "text", "key").unionByName(more, allowMissingColumns=True)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert result(suffix_dedup.dedup(both), *names) == sorted(expected, key=repr)


def test_previous_factors():
    rng = np.random.default_rng(5)
    for n, width, signs, ids in [(0, 4, 2, 3), (1, 4, 2, 1), (60, 6, 2, 9), (60, 6, 2, 60), (200, 3, 2, 4), (90, 8, 1, 30)]:
        strings = np.array(sorted(bytes((97 + rng.integers(0, signs, width)).tolist()) for _ in range(n)), f"S{width}")
        docs = rng.integers(0, ids, n)

        def shared(a, b):
            return next((k for k in range(width) if a[k] != b[k]), width)

        expected = [max([shared(a, b) for b, e in zip(strings, docs) if e < d], default=0) for a, d in zip(strings, docs)]
        assert suffix_dedup.previous_factors(strings, docs).tolist() == expected
        for least in (2, width):
            found = suffix_dedup.previous_factors(strings, docs, least)
            assert found.tolist() == [e if e >= least else 0 for e in expected]


def test_previous_factors_compared_in_parts(monkeypatch):
    strings = np.array(sorted(bytes([97 + k % 3, 97 + k % 2, 97 + k % 5]) for k in range(50)), "S3")
    docs = np.arange(50)[::-1].copy()
    plain = suffix_dedup.previous_factors(strings, docs).tolist()
    monkeypatch.setattr(suffix_dedup, "COMPARED_STRINGS", 7)
    assert suffix_dedup.previous_factors(strings, docs).tolist() == plain


def test_suffix_dedup_splits_hot_anchors(docs, monkeypatch):
    plain = result(suffix_dedup.dedup(docs), "doc_id", "n_removed", "n_spans", "kept_sha256")
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", 1)
    assert result(suffix_dedup.dedup(docs, ranges=200), "doc_id", "n_removed", "n_spans", "kept_sha256") == plain


def test_suffix_dedup_tells_ranges_of_equal_low_bits(monkeypatch):
    ranges, low = 1 << 20, np.uint64(77)
    hot, plain = (np.uint64(5) << np.uint64(44)) | low, (np.uint64(9) << np.uint64(44)) | low  # equal but for the range
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", 2)

    def rows(h, keys):
        n = len(keys)
        home = int(suffix_dedup._range_of(np.array([h]), ranges)[0])
        return (home, np.array(keys, np.int64).tobytes(), np.ones(n, np.uint32).tobytes(), np.full(n, h, np.uint64).astype(np.uint32).tobytes())

    sent = pd.DataFrame([rows(hot, [1, 2, 3, 4]), rows(plain, [1, 5])], columns=["range", "keys", "counts", "hashes"])
    shared = pd.concat(list(suffix_dedup._shared(iter([sent]))))
    of_one = shared[shared["key"] == 1]
    codes = suffix_dedup._in_range(suffix_dedup._range_of(np.array([hot, plain]), ranges), np.array([low, low], np.uint32))
    assert set(np.frombuffer(b"".join(of_one["hashes"]), np.uint64)) == set(codes)
    assert np.frombuffer(b"".join(of_one["hot"]), np.uint64).tolist() == [codes[0]]


def test_suffix_dedup_sorts_in_slices(docs, monkeypatch):
    plain = result(suffix_dedup.dedup(docs), "doc_id", "n_removed", "n_spans", "kept_sha256")
    monkeypatch.setattr(suffix_dedup, "SORTED_STRINGS", 3)
    data, rng = PROSE.encode() * 3 + b"x" * 200, np.random.default_rng(1)
    at = rng.integers(0, len(data) - 50, 400)
    parts = list(suffix_dedup._slices(data, at))
    assert sorted(np.concatenate(parts).tolist()) == list(range(400))
    heads = [{data[at[i] : at[i] + 8] for i in p} for p in parts]
    assert all(max(a) < min(b) for a, b in zip(heads, heads[1:]))
    assert result(suffix_dedup.dedup(docs, ranges=1), "doc_id", "n_removed", "n_spans", "kept_sha256") == plain


def jaccard_classes(rows, threshold=0.8):
    cache = ngram_join._Words()
    sets = [set(ngram_join.shingles(t or "", 5, cache).tolist()) for _, t in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        r = find(a)
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    return [(i, least[find(a)], links[a]) for a, (i, _) in enumerate(rows)]


def test_near_duplicates(docs, spark, monkeypatch):
    words = PROSE.split() * 3
    near = [(200 + k, " ".join(words[:k] + ["changed"] + words[k + 1 :])) for k in range(40)]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(near, "doc_id long, text string"))
    expected = sorted(jaccard_classes(rows_of(both)), key=repr)
    assert result(ngram_join.near_duplicates(both), "doc_id", "class_id", "n_links") == expected
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 7)  # units of block pairs
    assert result(ngram_join.near_duplicates(both), "doc_id", "class_id", "n_links") == expected
    kept = ngram_join.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sum(t == PROSE for _, t in rows_of(kept)) == 1


def test_next_depth():
    ask = lambda found, depth: ngram_join.next_depth(found, depth, 5, 0.8, 24, 0.9999)
    assert ask([0] * 20, 8) == 5  # nothing found proves nothing
    assert ask([0] * 18 + [10**6, 0], 8) is None  # near copies meet at whole signatures
    assert ask([10**6] + [0] * 19, 8) == 5 and ask([10**6] + [0] * 19, 5) is None
    assert ask([0] * 4 + [10**6] + [0] * 15, 8) == 6  # similarity of 0.84


def test_forest_rounds_give_what_one_round_gives(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(120):
        words = [f"w{x}" for x in rng.integers(0, 5000, 100)]
        for c in range(3):
            at = set(rng.choice(100, int(rng.integers(0, 4)), replace=False).tolist())
            rows.append((len(rows), " ".join(f"new{k}x{c}" if i in at else w for i, w in enumerate(words))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = sorted(jaccard_classes(rows), key=repr)
    names = ["doc_id", "class_id", "n_links"]
    depths, asked = [8], ngram_join.next_depth
    monkeypatch.setattr(ngram_join, "next_depth", lambda *a: depths.append(asked(*a)) or depths[-1])
    assert result(ngram_join.near_duplicates(docs), *names) == expected
    assert depths[-1] is None and depths[-2] < 8
    steps = iter([7, 6, 5, None])
    monkeypatch.setattr(ngram_join, "next_depth", lambda *a: next(steps))
    assert result(ngram_join.near_duplicates(docs), *names) == expected


def test_prefix_length():
    depth = ngram_join.prefix_length(0.8, 24, 0.9999)
    assert 1 - (1 - 0.8**depth) ** 24 >= 0.9999 > 1 - (1 - 0.8 ** (depth + 1)) ** 24


def test_decontamination(docs, spark):
    items = [(1, PROSE), (2, "One, two THREE!"), (3, None), (4, ""), (5, "not there at all in any of these texts"), (6, " ".join(LONG.split()[100:140])), (6, "tail")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))

    def grams(text, n):
        words = [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}

    expected = set()
    for i, t in rows_of(docs):
        for item, text in items:
            width = min(5, len([w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]))
            wanted = grams(text, width) if width else set()
            if wanted and len(grams(t, width) & wanted) >= 0.8 * len(wanted) - 1e-9:
                expected.add((i, item))
    assert result(decontaminate.leaks(docs, bench), "doc_id", "item_id") == sorted(expected, key=repr)
    clean = decontaminate.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in rows_of(docs)} - {i for i, _ in expected}


def test_decontamination_drops_only_leaking_texts(spark):
    texts = [f"clean text number {i} of its own" for i in range(4)]
    rows = [(None, PROSE), (None, texts[0]), (None, texts[1]), (None, None), (5, PROSE), (5, texts[2]), (6, texts[3])]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, PROSE)], "item_id long, text string")
    assert rows_of(decontaminate.without_leaks(made, bench).orderBy("doc_id", "text")) == [(None, None), (None, texts[0]), (None, texts[1]), (5, texts[2]), (6, texts[3])]
    assert decontaminate.without_leaks(made, bench.limit(0)).count() == len(rows)


def test_mixing(docs, spark):
    out = mixing.mixed(docs, {"src0": 2.0, "src1": 0.0}, epochs=3.0)
    assert set(docs.columns) <= set(out.columns)
    assert not [r for r in out.collect() if r["source"] == "src1"]
    assert result(out, "doc_id", "replica") == result(mixing.mixed(docs, {"src0": 2.0, "src1": 0.0}, epochs=3.0), "doc_id", "replica")
    many = spark.range(40000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source"))
    counts = dict(result(mixing.mixed(many, {"a": 3.0, "b": 1.0}).groupBy("source").count(), "source", "count"))
    assert abs(counts["a"] / 30000 - 1) < 0.03 and abs(counts["b"] / 10000 - 1) < 0.05
    spread = Counter(n for _, n in result(mixing.mixed(many, {"a": 3.0, "b": 1.0}).where("source = 'a'").groupBy("doc_id").count(), "doc_id", "count"))
    assert abs(spread[3] / 10000 - 0.224) < 0.02  # the Poisson share of 3 at mean 3


def test_mixing_of_null_and_repeated_ids(spark):
    i = F.col("id")
    key = F.when(i % 3 == 0, None).when(i % 3 == 1, F.lit(7)).otherwise(i)
    rows = spark.range(12000).select(key.alias("doc_id"), F.concat(F.lit("text "), i).alias("text"), F.lit("a").alias("source"))
    out = mixing.mixed(rows, {}).cache()
    kinds = Counter("null" if k is None else "hot" if k == 7 else "single" for k, _ in rows_of(out))
    assert all(abs(kinds[k] / 4000 - 1) < 0.06 for k in ("null", "hot", "single"))
    assert out.select("shuffle_key").distinct().count() == out.count()
    assert result(out, "doc_id", "text", "replica") == result(mixing.mixed(rows.repartition(5), {}), "doc_id", "text", "replica")


def test_mixing_of_equal_rows(spark):
    i = F.col("id")
    key = F.when(i % 3 == 0, None).when(i % 3 == 1, F.lit(7)).otherwise(i)
    text = F.when(i % 3 == 0, None).when(i % 3 == 1, F.lit("the same")).otherwise(F.concat(F.lit("text "), i))
    rows = spark.range(0, 12000, 1, 6).select(key.alias("doc_id"), text.alias("text"), F.lit("a").alias("source"))
    out = mixing.mixed(rows, {}).cache()
    kinds = Counter("null" if k is None else "hot" if k == 7 else "single" for k, _ in rows_of(out))
    assert all(abs(kinds[k] / 4000 - 1) < 0.06 for k in ("null", "hot", "single"))
    drawn = Counter("null" if k is None else "hot" if k == 7 else "single" for k, _ in rows_of(out.where("replica = 0")))
    twice = Counter("null" if k is None else "hot" if k == 7 else "single" for k, _ in rows_of(out.where("replica = 1")))
    assert all(abs(drawn[k] / 4000 - 0.632) < 0.03 and abs(twice[k] / 4000 - 0.264) < 0.03 for k in kinds)  # Poisson at mean 1
    assert out.select("shuffle_key").distinct().count() == out.count()
    assert result(out, "doc_id", "replica", "shuffle_key") == result(mixing.mixed(rows, {}), "doc_id", "replica", "shuffle_key")
    without = mixing.mixed(rows.drop("text"), {})
    assert abs(without.where("doc_id IS NULL").count() / 4000 - 1) < 0.06


def test_mixing_of_a_rare_source(spark):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 40, "rare").otherwise("b").alias("source"))
    counts = [n for _, n in result(mixing.mixed(rows, {"rare": 1.0, "b": 1.0}, epochs=200.0).where("source = 'rare'").groupBy("doc_id").count(), "doc_id", "count")]
    mean = sum(counts) / 40  # the rate is 2,500, its deviation 50
    assert len(counts) == 40 and abs(mean - 2500) < 40 and 20 < np.std(counts) < 90


def test_token_files(docs, spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = sorted(rows_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, expected = 0, []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert result(token_files.tokens_of(docs, tokenizer_path()), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=repr)


def test_encoder_equals_tokenizer_on_odd_texts():
    encoder = token_files._Encoder(tokenizer_path())
    odd = ["É'est İstanbul ΣΑΣ. áb 'tis don't..., ,., x<|endoftext|>y a1b2 \t\x0b\x85 z", "K K ½ ²", "日本語。", "a.b.c... ...", "\x00 a\x00b"]
    odd += ["Épaelle%%% ÄBERTZ$$$ naïve×3 ǅungla ß» (304) a_b-c~^`", "<|ENDOFTEXT|>", "ſt İ ŉ ĳ ﬁ e\u0301a", "".join(map(chr, range(33, 0x260)))]
    odd += [f"a{chr(c)}b" for c in range(0x260)]
    for text, got in zip(odd, encoder.encode(odd)):
        assert np.frombuffer(got, np.int32).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_token_files_of_six_digit_parts(spark, tmp_path):
    order = ["part-00007-u-c000.orc", "part-99999-u-c000.orc", "part-99999-u-c001.orc", "part-100000-u-c000.orc", "part-1000000-u-c000.orc"]
    for k, name in enumerate(order):
        orc.write_table(pa.table({"doc_id": pa.array([k], pa.int64()), "ids": pa.array([[k] * (k + 1)], pa.list_(pa.int32()))}), str(tmp_path / name))
    assert dict(result(token_files.token_index(spark, str(tmp_path)), "doc_id", "start")) == {0: 0, 1: 1, 2: 3, 3: 6, 4: 10}


def test_token_files_of_another_tokenizer(docs, spark, tmp_path):
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    other = Tokenizer.from_file(tokenizer_path())
    assert token_files._Encoder(tokenizer_path()).by_chunk
    for normalizer, cutter in [(normalizers.NFC(), other.pre_tokenizer), (other.normalizer, pre_tokenizers.ByteLevel(add_prefix_space=True))]:
        changed = Tokenizer.from_file(tokenizer_path())
        changed.normalizer, changed.pre_tokenizer = normalizer, cutter
        path = str(tmp_path / "other.json")
        changed.save(path)
        encoder = token_files._Encoder(path)
        texts = [t or "" for _, t in rows_of(docs)]
        assert not encoder.by_chunk
        assert [np.frombuffer(x, np.int32).tolist() for x in encoder.encode(texts)] == [changed.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_files_hold_stripes_indexes_and_bloom_filters(spark, tmp_path):
    rows = spark.range(40_000).select((F.col("id") * 2).alias("doc_id"), F.concat(F.lit("some words of "), "id").alias("text"))
    folder = token_files.write_tokens(rows.coalesce(1), str(tmp_path / "tokens"), tokenizer_path())
    read = token_files.read_tokens(spark, folder)
    assert read.count() == 40_000
    wanted = read.where("doc_id = 31234")
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,31234)" in plan and wanted.count() == 1
    reader = spark._jvm.org.apache.orc.OrcFile
    conf = spark._jsc.hadoopConfiguration()
    for name in sorted((tmp_path / "tokens").glob("part-*.orc"))[:1]:
        held = reader.createReader(spark._jvm.org.apache.hadoop.fs.Path(str(name)), reader.readerOptions(conf))
        assert held.getRowIndexStride() == 5000 and held.getStripes().size() >= 1 and str(held.getCompressionKind()) == "ZSTD"
        kinds, columns = set(), held.getSchema().getFieldNames()
        stripe = held.rows().readStripeFooter(held.getStripes().get(0))
        for k in range(stripe.getStreamsCount()):
            kinds.add((str(stripe.getStreams(k).getKind()), stripe.getStreams(k).getColumn()))
        at = 1 + list(columns).index("doc_id")
        assert ("ROW_INDEX", at) in kinds and ("BLOOM_FILTER_UTF8", at) in kinds and ("BLOOM_FILTER_UTF8", at + 1) not in kinds
        assert str(stripe.getColumns(at).getKind()) == "DIRECT_V2"


def test_license_scan(docs):
    phrases = {tuple(p.split()): v for p, v in license_scan.PHRASES.items()}
    templates = {k: set(w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", v.lower()) if w) for k, v in license_scan.TEMPLATES.items()}

    def lower(text):
        return re.sub("[A-Z]", lambda m: m[0].lower(), text)

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))

    expected = []
    for i, t in rows_of(docs):
        w = words(t or "")
        places = [(k, v) for p, v in phrases.items() for k in range(len(w)) if tuple(w[k : k + len(p)]) == p]
        shares = {k: max(len(v & set(words(line))) / len(v) for line in (t or "").split("\n")) for k, v in templates.items()}
        lines = [" " + " ".join(words(line)) + " " for line in (t or "").split("\n")]
        decided = {k for k in templates if any(all(" " + " ".join(words(p)) + " " in line for p in license_scan.DECIDING.get(k, ())) for line in lines)}
        found = {k.split("/")[0]: s for k, s in shares.items() if s >= license_scan.THRESHOLD - 1e-9 and k in decided}
        base = sorted({v for _, v in places})
        starts = [k for k, _ in places]
        score = 1.0 if places else max(found.values(), default=0.0)
        expected.append((i, len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(sorted({*base, *found})), score))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert result(license_scan.scan(docs), *names) == sorted(expected, key=repr)


def test_license_scan_by_windows_of_words(spark):
    bsd, mpl = license_scan.TEMPLATES["bsd-3-clause"], license_scan.TEMPLATES["mpl-2.0"]
    scattered = [f"filler{i}" for i in range(400)]
    for k, word in enumerate("released under the mit license".split()):
        scattered[60 * k] = word
    rows = [
        (1, "# " + bsd.replace("without modification", "without\n# modification") + " provided that"),
        (2, "/* " + mpl.replace("Mozilla Public", "Mozilla Public\r\n * ") + ". */"),
        (3, " ".join(scattered)),
        (4, " ".join(scattered[:200]) + " Released under the MIT\n\nLicense. " + " ".join(scattered[200:])),
        (5, "Released by us under the new MIT License"),
    ]
    out = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    assert dict(result(out, "doc_id", "labels")) == {1: "bsd-3-clause", 2: "mpl-2.0", 3: "", 4: "mit", 5: "mit"}


def test_license_versions_and_variants(spark):
    texts = {
        "gpl,gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
        "gpl,gpl-3.0": "You may use it under the terms of the GNU General Public License\n# as published by the Free Software Foundation, either version 3 of the\n# License, or any later version",
        "lgpl-2.1": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "lgpl-3.0": license_scan.TEMPLATES["lgpl-3.0"],
        "agpl-3.0": license_scan.TEMPLATES["agpl-3.0"],
        "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "cc-by-nc-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "cc-by,cc-by-nc-nd-4.0": "Licensed under CC BY-NC-ND 4.0",
        "cc-by,cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
        "cc-by,cc-by-4.0,cc-by-nc-4.0": "Text licensed under CC BY 4.0, pictures licensed under CC BY-NC 4.0.",
        "apache-2.0,mit": "Licensed under the Apache License, Version 2.0. Released under the MIT License.",
        "bsd": license_scan.TEMPLATES["bsd"] + " provided that the following conditions are met",
        "bsd,bsd-3-clause": license_scan.TEMPLATES["bsd"] + " provided that. " + license_scan.TEMPLATES["bsd-3-clause"],
        "": "the license of this version 3 commons work is under general public terms",
    }
    made = spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")
    labels = dict(result(license_scan.scan(made), "doc_id", "labels"))
    expected = dict(enumerate(texts))
    expected.update({k: "gpl," + v for k, v in expected.items() if v.startswith(("lgpl", "agpl"))})  # the base phrase stands there, too
    assert {k: set(v.split(",")) for k, v in labels.items()} == {k: set(v.split(",")) for k, v in expected.items()}


def test_license_windows_by_brute_force(spark):
    rng, low = np.random.default_rng(5), license_scan._low_words
    notices = list(license_scan.TEMPLATES.items())
    texts = []
    for k in range(120):
        name, notice = notices[k % len(notices)]
        words = notice.split()
        for _ in range(k % 3):  # words lost, words between
            words.pop(int(rng.integers(len(words)))) if rng.random() < 0.5 else words.insert(int(rng.integers(len(words))), "other")
        texts.append(" ".join(["start", "of"] * int(rng.integers(9)) + words + notices[int(rng.integers(len(notices)))][1].split()[: int(rng.integers(12))]))

    def holds(words, name, notice):
        tokens, window = set(low(notice)), license_scan.SPREAD * len(low(notice))
        for i in range(len(words)):
            part = words[i : i + window]
            phrases = all(any(part[j : j + len(p)] == p for j in range(len(part))) for p in map(low, license_scan.DECIDING.get(name, ())))
            if phrases and len(tokens & set(part)) >= license_scan.THRESHOLD * len(tokens) - 1e-9:
                return True
        return False

    expected = {k: {n.split("/")[0] for n, v in notices if holds(low(t), n, v)} for k, t in enumerate(texts)}
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = license_scan.scan(made).collect()
    assert {r["doc_id"]: set(r["labels"].split(",")) - set(r["base_labels"].split(",")) - {""} for r in out} == expected
    assert sum(map(len, expected.values())) > 60


def base_pii(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_personal_data(docs, spark):
    extra = [(300 + k, f"{t}") for k, t in enumerate(["9" * 5000, "1 " * 3000, "a" * 20000 + "@", "+1" + "(" * 3000 + "2", "1.1.1.1" * 50, "-4111-1111-1111-1111-", "4111  111111111111", "4111 1111 1111 1111"])]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    expected = []
    for i, t in rows_of(both):
        found = base_pii(t or "")
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in found)
        expected.append((i, *[sum(x[1] == k for x in found) for k in range(4)], hashlib.sha256(text.encode()).hexdigest()))
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    assert result(pii.find(both), *names) == sorted(expected, key=repr)


def test_personal_data_bootstraps_contexts(spark):
    rows = [(k, f"some words first, member mail: user{k}@mail.example.org and more") for k in range(6)]
    rows += [(10, "some words first, member mail: AB12-9931 and more"), (11, "room B1234567 is open")]
    spans = dict(result(pii.find(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "spans"))
    at = rows[6][1].index("AB12-9931")
    assert spans[10] == f"id:{at}:{at + 9}" and spans[11] == ""
    assert spans[0].startswith("email:")


def test_personal_data_bootstraps_from_spaced_seeds(spark):
    names = ["ada", "bob", "cyd", "dan"]
    rows = [(k, f"please write to: {n}@mail.example.org soon") for k, n in enumerate(names)]
    rows += [(10 + k, f"office Tel: +1 (017) 555-77{k}3 is open") for k in range(4)]
    cards = ["4111 1111 1111 1111", "5500 0000 0000 0004", "3400 0000 0000 009", "6011 0000 0000 0004"]
    rows += [(20 + k, f"paid by card no {c} today") for k, c in enumerate(cards)]
    unseen = {30: ("please write to: ", "ID77-4410"), 31: ("office Tel: ", "017 555 7799"), 32: ("paid by card no ", "4111 1111 1111 1112")}
    rows += [(i, f"{lead}{value} soon") for i, (lead, value) in unseen.items()]
    spans = dict(result(pii.find(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "spans"))
    assert {i: spans[i] for i in unseen} == {i: f"id:{len(a)}:{len(a) + len(b)}" for i, (a, b) in unseen.items()}
    assert all(spans[i].startswith(("email:", "phone:", "card:")) and "id:" not in spans[i] for i in spans if i < 30)


def bootstrapped(rows):
    """All spans of every text, by plain loops."""
    instances = []
    for i, t in rows:
        base = base_pii(t)
        open_ = list(t)
        for a, _, b in base:
            open_[a:b] = pii.MASK * (b - a)
        open_ = "".join(open_)
        found = [(a, b, True) for a, _, b in base]
        for m in regex.finditer(pii.TOKENS, open_):
            beside = {*open_[max(m.start() - 1, 0) : m.start()], *open_[m.end() : m.end() + 1]}
            if m.end() - m.start() >= pii.SHORTEST and pii.MASK not in beside:
                found.append((m.start(), m.end(), False))
        for a, b, seed in found:
            lead = regex.search(r"([^\t-\r ]*[\t-\r ]*[^\p{L}\p{N}\t-\r ]*)$", t[max(a - pii.CONTEXT, 0) : a])[1]
            instances.append((i, a, b, t[a:b].lower(), re.sub("[0-9]", "0", lead.lower()).strip(" "), seed))
    instances = [x for x in instances if x[4]]
    values, known = defaultdict(set), {x[3] for x in instances if x[5]}
    for x in instances:
        values[x[4]].add(x[3])
    good = set()
    while True:
        more = {c for c, v in values.items() if len(v & known) >= pii.MIN_KNOWN and len(v & known) >= pii.CONFIDENCE * len(v)}
        if more == good:
            break
        good = more
        known |= {v for c in good for v in values[c]}
    out = {}
    for i, t in rows:
        added = [(x[1], len(pii.KINDS), x[2]) for x in instances if x[0] == i and not x[5] and x[4] in good]
        out[i] = ",".join(f"{(*pii.KINDS, pii.ADDED)[k]}:{a}:{b}" for a, k, b in sorted({*base_pii(t), *added}))
    return out


def test_personal_data_added_spans_by_brute_force(spark):
    rng = np.random.default_rng(8)
    leads = ["mail: ", "tel. ", "member no ", "see ", "(ref) ", "room: "]
    make = [lambda n: f"user{n}@mail.example.org", lambda n: f"+1 (017) 555-{n:04d}", lambda n: f"AB-{n:05d}", lambda n: f"10.{n % 256}.0.{n % 99}", lambda n: f"{n:04d} {n:05d}x"]
    rows = []
    for k in range(80):
        parts = []
        for _ in range(int(rng.integers(1, 12))):
            lead, n = int(rng.integers(len(leads))), int(rng.integers(40))
            kind = lead % 5 if rng.random() < 0.85 else int(rng.integers(5))
            parts.append("some words " * int(rng.integers(3)) + leads[lead] + make[kind if lead != 2 or rng.random() < 0.1 else 0](n) + ["", ",", " and"][int(rng.integers(3))])
        rows.append((k, " ".join(parts)))
    expected = bootstrapped(rows)
    found = dict(result(pii.find(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "spans"))
    assert found == expected
    assert sum("id:" in v for v in expected.values()) > 5


def test_personal_data_in_long_texts(spark):
    body = " ".join(f"item {k:07d}" for k in range(40_000)) + " tail +1 (555) 123-4567 " + "x" * 3000 + "@mail.example.org \U0001f600 10.0.0.1"
    start = time.time()
    row = pii.find(spark.createDataFrame([(1, body)], "doc_id long, text string")).first()
    assert time.time() - start < 60  # appending to arrays and walking from the start took minutes
    assert row["spans"] == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base_pii(body))


def test_running_sums(spark):
    rows = [(k, list(range(-3, k))) for k in (-3, -2, 0, 13, 14, 500)]
    made = spark.createDataFrame(rows, "n int, v array<int>")
    out = dict(result(made.select("n", pii.running(F.col("v")).alias("sums")), "n", "sums"))
    assert out == {k: np.cumsum(v).tolist() for k, v in rows}


def test_personal_data_iterates_to_the_end(spark):
    edges = [("c0", v, True) for v in (0, 1, 2, 3)]
    for k in range(1, 6):  # each context shares four values with the one before and has one of its own
        edges += [(f"c{k}", v, False) for v in range(k, k + 4)] + [(f"c{k - 1}", k + 3, False)]
    made = spark.createDataFrame(edges, "context string, value long, seed boolean")
    assert {r["context"] for r in pii.trusted(made).collect()} == {f"c{k}" for k in range(6)}


def test_revisits(spark):
    at = "2024-01-0{} 00:00:00".format
    full = lambda i, url, day, tag, **more: (i, url, at(day), "response", 200, {"ETag": tag, "Content-Type": "text/html", "Date": str(day), **more}, f"d{i}")
    again = lambda i, url, day, tag, **more: (i, url, at(day) if day else None, "revisit", 304, {"etag": tag, "date": f"r{day}", "content-type": "no", **more} if tag else None, None)
    rows = [
        full(1, "http://www.A.org/x/", 1, '"a"'),
        full(2, "https://a.org:443/x#top", 2, '"b"'),
        ("3", "http://a.org/x", at(3), "response", 404, {"ETag": '"c"'}, "d3"),
        again(4, "a.org/x?utm_source=f", 4, 'W/"b"'),
        again(5, "http://a.org/x", 1, '"a"'),
        again(6, "http://a.org/x", 5, '"z"'),
        again(7, "http://b.org/", 5, '"z"'),
        again(8, None, 5, '"z"'),
        again(9, "http://a.org/x", None, '"b"'),
        again(10, "http://a.org/x", 6, None),
        (11, "http://a.org/x", at(7), "other", None, None, None),
    ]
    rows = [(int(r[0]), *r[1:]) for r in rows]
    made = spark.createDataFrame(rows, "record_id long, url string, at string, kind string, status int, headers map<string,string>, digest string")
    out = warc.resolve(made.withColumn("at", F.to_timestamp("at")).withColumn("slice", F.lit("clash")), slices=4)
    found = {r["record_id"]: r for r in out.collect()}
    assert {i: r["outcome"] for i, r in found.items()} == {4: "resolved", 5: "resolved", 6: "changed", 7: "missing", 8: "missing", 9: "missing", 10: "changed"}
    assert found[4]["response_id"] == 2 and found[5]["response_id"] == 1 and found[4]["digest"] == "d2"
    assert found[4]["headers"] == {"etag": 'W/"b"', "content-type": "text/html", "date": "r4"}
    assert out.where(F.lit(False)).count() == 0


def test_quotations(spark):
    rows = [
        (1, 0, "user", "Hello there\nhow are you?"),
        (1, 1, "assistant", "On Monday, Bob wrote:\n> Hello there\n> how are you?\nFine, thanks."),
        (1, 2, "user", ">> Hello there\n>> how are you?\n> Fine, thanks.\nGood."),
        (1, 3, "user", "> never said\nreply"),
        (1, 4, "user", None),
        (1, 5, "user", ""),
        (2, 0, "user", "> Fine, thanks.\nother conversation"),
        (None, 0, "user", "root"),
        (None, 1, "user", "> root\nleaf"),
        (1, None, "user", "> Good.\nno turn"),
    ]
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("level", F.lit("clash"))
    out = {(r["conv_id"], r["turn"]): r for r in chat.link(made).collect()}
    assert len(out) == len(rows)
    assert [out[1, k]["reply_to"] for k in range(6)] == [None, 0, 1, None, None, None]
    assert [out[1, k]["depth"] for k in range(4)] == [0, 1, 2, 0] and out[1, 2]["root"] == 0
    assert out[1, 1]["own_text"] == "Fine, thanks." and out[1, 2]["n_quotes"] == 2 and out[1, 2]["n_linked"] == 2
    assert out[1, 3]["n_quotes"] == 1 and out[1, 3]["n_linked"] == 0
    assert out[2, 0]["reply_to"] is None and out[None, 1]["reply_to"] == 0 and out[1, 4]["own_text"] == ""


def test_trimmed_quotations(spark):
    lines = [f"line {k} of the first message" for k in range(5)]
    rows = [
        (1, 0, "\n".join(lines)),
        (1, 1, "\n".join(lines[:3]) + "\nand a line of its own\nmore"),
        (1, 2, f"> {lines[3]}\n> {lines[4]}\ntwo lines"),
        (1, 3, f"> {lines[1]}\n> {lines[2]}\n> and a line of its own\nthe second wrote all three"),
        (1, 4, f"> {lines[0]}\n> [...]\n> {lines[4]}\ncut within"),
        (1, 5, "> two lines of nobody\n> at all\nreply"),
        (None, 0, "\n".join(lines)),
        (None, 1, f"> {lines[2]}\n> {lines[3]}\nleaf"),
    ]
    made = spark.createDataFrame(rows, "conv_id long, turn long, text string").withColumn("role", F.lit("user"))
    out = {(r["conv_id"], r["turn"]): r for r in chat.link(made).collect()}
    assert [out[1, k]["reply_to"] for k in range(6)] == [None, None, 0, 1, 0, None] and out[None, 1]["reply_to"] == 0
    assert [out[1, k]["n_linked"] for k in range(6)] == [0, 0, 1, 1, 1, 0] and out[1, 2]["depth"] == 1
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "one\ntwo\nthree"), (1, 2, "user", "b")]
    mails = chat.quoting(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    assert "> one" not in dict(result(mails, "turn", "text"))[2]
    assert {r["turn"]: r["reply_to"] for r in chat.link(mails).collect()} == {0: None, 1: 0, 2: 1}


@pytest.mark.parametrize(
    "run",
    [
        quality_rules.quality,
        suffix_dedup.dedup,
        ngram_join.near_duplicates,
        ngram_join.one_per_class,
        license_scan.scan,
        pii.find,
        lambda d: mixing.mixed(d, MIX_WEIGHTS),
        lambda d: token_files.tokens_of(d, tokenizer_path()),
        lambda d: decontaminate.leaks(d, d.select(F.col("doc_id").alias("item_id"), "text")),
        lambda d: warc.resolve(warc.captures_of(d.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html")))),
        lambda d: chat.link(d.select(F.col("doc_id").alias("conv_id"), F.col("doc_id").alias("turn"), F.col("source").alias("role"), "text")),
    ],
)
def test_empty_tables(docs, run):
    assert run(docs.limit(0)).count() == 0
