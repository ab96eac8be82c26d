"""The stages of the pipeline, and quotations of repeated and long messages."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caseline.llm import chat
from caseline.llm.queries import tokenizer_path

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, n_words int, kept string, _m string, _th string, replica string,"
    " shuffle_key string, first string, beside string, th string, base_failed string"
)
ITEM = "the seventh lighthouse keeper of the northern island wrote down every ship that passed in the winter of the great storm"


def prose(seed, n=60):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(n))


WORDS = [f"{a}{b}" for a in ("riv", "mount", "harv", "wind", "cand", "mark", "wint", "lett", "gard", "bridg") for b in ("er", "ain", "est", "ow", "le", "et", "ing", "ed", "en", "es")]


def changed(text):
    return text.replace(text.split()[30], "elsewhere", 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pipeline")
    texts = [(k, prose(k)) for k in range(12)]
    texts += [(20, prose(3)), (21, changed(prose(200, 80))), (22, prose(200, 80)), (23, prose(9) + " " + ITEM + " " + prose(10)), (24, "too short")]
    texts += [(25, None), (26, ""), (None, prose(300)), (None, prose(301)), (5, prose(5)), (5, prose(302)), (27, "spam " * 80)]
    rows = [(i, t, "en", f"src{k % 4}" if k else None, 9, -5 - k, "no", "m", f"t{k}", "r", "s", "f", "b", "h", "x") for k, (i, t) in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_keep_columns_and_values(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    every = set(rows_of(docs))
    by_key = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = rows_of(docs)
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        after = rows_of(out)
        assert set(after) <= set(before) <= every, name
        by_key[name] = [(r[0], r[1]) for r in after]
        docs = spark.createDataFrame(after, docs.schema)
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    start = [(r[0], r[1]) for r in every]
    good = sorted(((i, t) for i, t in start if len(words(t)) >= 20 and "spam" not in t), key=repr)
    assert sorted(by_key["quality_rules"], key=repr) == good

    def grams(t):
        w = [x.lower() for x in words(t)]
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    left = []
    for i, t in sorted(good, key=lambda r: (r[0] is None, r[0] or 0)):
        if not any(len(grams(t) & grams(u)) >= 0.8 * len(grams(t) | grams(u)) for _, u in left):
            left.append((i, t))
    assert len(left) < len(good) and sorted(by_key["near_duplicates"], key=repr) == sorted(left, key=repr)
    clean = sorted(((i, t) for i, t in left if ITEM not in t), key=repr)
    assert len(clean) == len(left) - 1 and sorted(by_key["decontamination"], key=repr) == clean
    assert set(by_key["mixing"]) <= set(clean)


def test_pipeline_encodes_what_the_stages_keep(spark, folder):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        docs = spark.createDataFrame(kept.collect(), docs.schema)
    encoder = Tokenizer.from_file(tokenizer_path())
    expected = sorted(len(encoder.encode(r["text"], add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert sorted(r["n_tokens"] for r in corpus_pipeline.run(spark, folder).collect()) == expected


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.collect() == [], name
        if name != "token_files":
            assert out.columns == docs.columns
    assert corpus_pipeline.kept_beside(docs.select("text"), ["text"], lambda d: d).columns == ["text"]


MAIL = "conv_id long, turn int, role string, text string"


def brute_links(rows):
    """reply_to, n_quotes, n_linked and own text of messages that quote whole runs, by comparing all of them."""
    norm = lambda t: " ".join(t.lower().split())
    out = []
    for conv, turn, _, text in rows:
        runs = chat.runs_of(text or "")
        own = "\n".join(b for level, b in runs if level == 0).strip()
        quotes = [(level, norm(b)) for level, b in runs if level and norm(b)]
        sources = []
        for _, q in quotes:
            wrote = [
                t for c, t, _, other in rows
                if c == conv and t is not None and turn is not None and t < turn
                for level, b in chat.runs_of(other or "")
                if level == 0 and (norm(b) == q or q in [norm(x) for x in b.split("\n")])
            ]
            sources.append(min(wrote, default=None))
        outer = next((s for (level, _), s in zip(quotes, sources) if level == 1), None)
        out.append((conv, turn, outer, len(quotes), sum(s is not None for s in sources), own))
    return sorted(out, key=repr)


def linked(spark, rows):
    got = chat.link(spark.createDataFrame(rows, MAIL)).select("conv_id", "turn", "reply_to", "n_quotes", "n_linked", "own_text")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_quotations_of_repeated_rows(spark):
    rows = [
        (1, 0, "user", "Hello there"), (1, 0, "user", "Hello there"), (1, 0, "user", "another text"), (1, 1, "bot", "> Hello there\nwell met"),
        (1, 1, "bot", "> Hello there\nwell met"), (1, 2, "user", "> well met\n>> Hello there\nindeed"), (1, 3, "user", "> nobody wrote this\nhm"),
        (2, 5, "user", "> well met\nfrom elsewhere"), (None, None, "user", "same"), (None, None, "user", "same"), (None, None, "user", "> same\nyes"),
        (None, 4, "user", "first"), (None, 5, "user", "> first\nsecond"), (3, 0, "user", None), (3, 1, "user", ""), (3, 2, "user", "> \n> "),
    ]
    assert linked(spark, rows) == brute_links(rows)


def test_a_long_quotation_is_linked_in_a_minute(spark):
    lines = [f"line {k} of a long letter about {k * 7919 % 1000}" for k in range(20_000)]
    rows = [(1, 0, "user", "\n".join(lines)), (1, 1, "user", "\n".join("> " + x for x in lines[1:]) + "\nthanks")]
    start = time.monotonic()
    got = linked(spark, rows)
    assert got[1][:5] == (1, 1, 0, 1, 1) and got[0][5] == "\n".join(lines) and time.monotonic() - start < 60
