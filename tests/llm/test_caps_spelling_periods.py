"""Vector caps, spelling variants and periodic runs against brute-force versions."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseline.llm import periodic, spelling, vector_caps
from caseline.llm.queries import QUERIES

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, n int, word string, runs string"
VECTORS = "vec_id long, embedding array<float>, label int, node string, n_links int, filter string, copies string"


def result(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def texts():
    rnd = random.Random(5)
    stems = ["spelling", "variant", "grouping", "bookkeeper", "Straße", "übermäßig", "letters", "lettters", "leters", "aaaaaa", "aaaaaaa"]
    typos = [w[:k] + c + w[k + 1 :] for w in stems for k in (0, 3, len(w) - 1) for c in "xé"]
    typos += [w[:k] + w[k + 1 :] for w in stems for k in range(len(w))] + [w[:k] + "é" + w[k:] for w in stems for k in range(len(w) + 1)]
    out = [" ".join(rnd.choice(stems) for _ in range(80)) for _ in range(40)]
    out += [" ".join(rnd.choice(typos) for _ in range(60)) for _ in range(30)]
    out += ["", " \n\t ", None, "$$$", "a b a b a b a b", "x " * 300, "one\x0btwo\x0c" * 12, "it is. " * 5 + "and then it is. it is. it is. it is. end"]
    out += ["word word " * 9, "  line \u0085 next " * 7, "×÷×÷×÷ ÀÿÀÿÀÿ " * 6, "LOUD letters, LOUD LETTERS!"]
    out.append(" ".join(f"w{i % 700}" for i in range(5000)))
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    made = texts()
    rows = [(i, t, "en", "src0", 1, 7, "clash", "clash") for i, t in enumerate(made)]
    rows += [(None, made[0], None, None, None, 7, "clash", "clash"), (None, made[0], None, None, None, 7, None, None)]
    rows += [(3, made[3], "en", "src1", 2, 7, "clash", "clash")] * 2
    rows += [(-5, made[4], "en", "src1", 2, 7, "clash", "clash"), (2**62 + 1, made[-1], "en", "src1", 2, 7, "clash", "clash")]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    return str(path)


def read(spark, folder):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(counts, ratio=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts), key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_spelling_query(spark, folder):
    counts = Counter()
    lowered = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc_id, text in read(spark, folder):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lowered)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 6
    frequent = {w: n for w, n in counts.items() if n >= 5}
    expected = brute_variants(frequent)
    assert sum(x[1] is not None for x in expected) > 10
    assert result(QUERIES["op12_spelling_variants"](spark, folder), *COLUMNS) == expected


def test_spelling_chains_ties_and_odd_words(spark):
    # each a step from the one before, six times as often: the root is four forms away
    counts = {"a" * 6 + "b" * k: 6**k for k in range(5)}
    counts |= {"cat": 30, "bat": 30, "hat": 5, "at": 1, "é": 9, "éé": 9, "\U0001f600x": 50, "x": 10, "alone": 3}
    rows = [(w, n, "clash") for w, n in counts.items()] + [(None, 3, "clash"), ("no$word", 9, "clash"), ("nothing", None, "clash"), ("", 4, "clash")]
    rows += [("cat", 0, "clash")]
    words = spark.createDataFrame(rows, "word string, n long, form string")
    out = result(spelling.variants(words), *COLUMNS)
    assert out == brute_variants(counts)
    assert ("aaaaaa", "aaaaaab", "aaaaaabbbb", 1, 1, 6) in out and ("hat", "bat", "bat", 5, 3, 30) in out


def test_spelling_of_random_words(spark):
    rnd = random.Random(2)
    counts = {"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 7))): rnd.randint(1, 40) for _ in range(150)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert result(spelling.variants(words, 3), *COLUMNS) == brute_variants(counts, 3)


def test_each_pair_of_words_meets_once(spark):
    words = spark.createDataFrame([("book", 2), ("boook", 2), ("look", 2), ("boo", 2), ("ook", 2)], "word string, n long")
    met = spelling.neighbours(words).groupBy("word").agg(F.sum("n_near")).collect()
    assert dict(map(tuple, met)) == {"book": 4, "boook": 1, "look": 2, "boo": 1, "ook": 2}


def brute_runs(words, least=6, exponent=4):
    out = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            end = i + q
            i += 1
            if end - start >= max(least, exponent * q):
                w = words[start:end]
                if not any(w[d:] == w[:-d] for d in range(1, q)):
                    out.append((start, end - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {k for start, length, q in runs for k in range(start + q, start + length)}
    return [w for k, w in enumerate(words) if k not in gone]


def test_periodic_query(spark, folder):
    expected = []
    for doc_id, text in read(spark, folder):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = len(words)
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        hashes = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, " ".join(collapse(words, runs)))]
        expected.append((doc_id, len(runs), *best, milli, *hashes))
    assert sum(x[1] > 0 for x in expected) > 8
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert result(QUERIES["op13_periodic_runs"](spark, folder), *names) == sorted(expected, key=repr)


def test_runs_of_random_words():
    rnd = random.Random(1)
    for _ in range(600):
        n = rnd.randint(0, 60)
        words = [rnd.randrange(rnd.choice((1, 2, 3, 8))) for _ in range(n)]
        if n > 10 and rnd.random() < 0.6:
            a = rnd.randrange(n)
            p = 1 + (n - a) // (3 + rnd.randrange(8))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        for least, exponent in ((6, 4), (2, 2), (5, 3)):
            got = periodic.runs_of(np.array(words, np.int64), least, exponent)
            assert [tuple(r) for r in got.tolist()] == brute_runs(words, least, exponent)


def test_runs_of_texts_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(periodic, "BATCH_WORDS", 5)
    docs = spark.createDataFrame([(k, "spam spam spam") for k in range(9)] + [(9, "ham " * 7)], "doc_id int, text string")
    got = {r["doc_id"]: r for r in periodic.periodic_runs(docs.coalesce(1)).collect()}
    assert [tuple(x) for x in got[9]["runs"]] == [(0, 7, 1)] and got[9]["collapsed"] == "ham"
    assert all(not got[k]["runs"] and got[k]["collapsed"] == "spam spam spam" and got[k]["n_words"] == 3 for k in range(9))


def test_a_very_long_periodic_text(spark):
    text = "to be or not " * 40_000 + "that is it " * 30_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = periodic.periodic_runs(docs).first()
    assert [tuple(x) for x in row["runs"]] == [(0, 160_000, 4), (160_000, 90_000, 3)]
    assert row["collapsed"] == "to be or not that is it"


def vector_rows():
    rng = np.random.default_rng(4)

    def near(center, angle):
        side = rng.standard_normal(len(center))
        side -= side @ center * center
        return np.cos(angle) * center + np.sin(angle) * side / np.linalg.norm(side)

    rows, centers = [], rng.standard_normal((12, 24))
    for k, c in enumerate(centers / np.linalg.norm(centers, axis=1, keepdims=True)):
        rows += [(near(c, rng.uniform(0, 0.14)) * rng.uniform(0.1, 9), k % 3) for _ in range(12)]
    hot = centers[0] / np.linalg.norm(centers[0])
    rows += [(near(hot, 0.11), 0) for _ in range(150)] + [(hot, 0)] * 40
    rows += [(rng.standard_normal(24), int(rng.integers(0, 3))) for _ in range(200)]
    rows += [(hot, None), (hot * 1e-30, 0), (hot * 1e30, 0), (-hot, 0), (np.zeros(24), 0), (None, 0), (np.array([]), 0)]
    rows += [(hot[:5], 0), (hot[:5] * 2, 0), (np.array([1.0]), 1), (np.array([3.0]), 1), (np.array([-1.0]), 1)]
    out = [[i * 3 % 1009, None if v is None else [float(x) for x in v], label] for i, (v, label) in enumerate(rows)]
    for bad in (None, float("nan"), float("inf")):
        out.append([2000 + len(out), [bad, *out[0][1][1:]], 0])
    out += [[None, out[0][1], out[0][2]], [None, out[1][1], 77], out[5], out[5]]
    return [(*r, "clash", 7, "clash", "clash") for r in out]


def brute_links(rows, threshold=0.98):
    def usable(v):
        return bool(v) and all(x is not None and np.isfinite(np.float32(x)) for x in v) and any(np.float32(x) != 0 for x in v)

    units = []
    for _, v, label, *_ in rows:
        if label is not None and usable(v):
            w = np.array(v, np.float32).astype(np.float64)
            w = w / np.abs(w).max()
            units.append(((label, len(w)), w / np.linalg.norm(w)))
        else:
            units.append(None)
    n = len(rows)
    links = [[j for j in range(n) if j != i and units[i] and units[j] and units[i][0] == units[j][0] and units[i][1] @ units[j][1] >= threshold] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1024, 32])
def test_vector_caps_query(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(vector_caps, "BLOCK_VECTORS", block)
    rows = vector_rows()
    spark.createDataFrame(rows, VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op11_vector_caps"](spark, str(tmp_path))
    assert result(got, "vec_id", "n_links", "component_id", "kept") == brute_links(rows)


def test_a_pair_counts_in_one_filter(spark, monkeypatch):
    # few words and long lists: every pair meets in very many filters
    monkeypatch.setattr(vector_caps, "LISTED", 60)
    monkeypatch.setattr(vector_caps, "FEW", 3)
    rows = vector_rows()
    made = spark.createDataFrame(rows, VECTORS)
    got = vector_caps.near_duplicates(made, unrelated=20.0)
    assert result(got, "vec_id", "n_links", "component_id", "kept") == brute_links(rows)


def test_lists_hold_all_exceeding_filters():
    rng = np.random.default_rng(0)
    unit = vector_caps.units_of(rng.standard_normal((40, 10)))
    for blocks in (1, 2, 3):
        code = vector_caps.Code(10, 5, blocks, 1)
        row, found, _ = code.decode(unit, 0.3)
        directions = np.zeros((10, 5**blocks))
        for f in range(5**blocks):
            for k, (a, b) in enumerate(zip(code.bounds[:-1], code.bounds[1:])):
                directions[a:b, f] = code.books[k][:, f // 5 ** (blocks - 1 - k) % 5]
        assert np.allclose(np.linalg.norm(directions, axis=0), 1)
        expected = np.argwhere(unit @ code.rotation @ directions >= 0.3)
        assert sorted(zip(row.tolist(), found.tolist())) == sorted(map(tuple, expected.tolist()))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no analytics tables here")
def test_vector_caps_recall_on_given_tables(spark):
    """Against brute force over whole tables, with the links of a planted near copy for each fifth vector."""
    made = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    rng = np.random.default_rng(9)
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in made]
    for vec_id, v, label in rows[::5]:
        w = np.array(v) / np.linalg.norm(v)
        side = rng.standard_normal(len(w))
        side = (side - side @ w * w) / np.linalg.norm(side - side @ w * w)
        rows.append((100_000 + vec_id, [float(x) for x in w + np.tan(0.19) * side], label))
    got = vector_caps.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    found = got.agg(F.sum("n_links")).first()[0]
    assert 0.9 * sum(x[1] for x in brute_links(rows)) <= found <= sum(x[1] for x in brute_links(rows))


def test_empty_tables(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], DOCUMENTS)).collect() == []
    assert spelling.variants(spelling.word_counts(spark.createDataFrame([], DOCUMENTS))).collect() == []
    assert vector_caps.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []
