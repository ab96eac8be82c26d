"""The corpus operators as queries over the given tables, each with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseline.llm import (
    chat,
    decontaminate,
    license_scan,
    mixing,
    ngram_join,
    periodic,
    pii,
    quality_rules,
    spelling,
    suffix_dedup,
    token_files,
    vector_caps,
    warc,
)
from caseline.llm.common import let, table, whole

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Relative target weights of the sources in the mixture; the others have 1.
MIX_WEIGHTS = {"src0": 2.0, "src1": 3.0, "src2": 0.5, "src3": 0.25}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules.quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op4_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    return mixing.mixed(docs, MIX_WEIGHTS).select(
        "doc_id", "source", "replica", F.md5("text").alias("text_md5")
    )


@query
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.tokens_of(table(spark, folder, "documents"), tokenizer_path())


@query
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links")


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


@query
def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


@query
def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, folder, "documents"))


@query
def op7_revisit_resolution(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.resolve(warc.captures_of(table(spark, folder, "pages").select("page_id", "url", "html")))
    return found.select(
        "record_id",
        "canonical",
        "outcome",
        "response_id",
        "digest",
        F.col("headers")["etag"].alias("etag"),
        F.col("headers")["content-length"].alias("content_length"),
        F.col("headers")["date"].alias("date"),
    )


@query
def op9_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    linked = chat.link(chat.quoting(table(spark, folder, "conversations")))
    return linked.withColumn("own_md5", F.md5("own_text")).drop("own_text")


@query
def op11_vector_caps(spark: SparkSession, folder: str) -> DataFrame:
    return vector_caps.near_duplicates(table(spark, folder, "embeddings"))


#: One occurrence in so many loses a character, so that variants are there to be found.
MISSPELT = 199


def _misspelt(run: Column) -> Column:
    """A run of one document, without one of its characters where its hash says so."""
    h = F.crc32(F.concat_ws(":", F.col("doc_id").cast("string"), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(F.col("doc_id").isNotNull() & (h % MISSPELT == 0), shorter).otherwise(run)


@query
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return spelling.variants(spelling.word_counts(docs, edit=_misspelt))


def _repeating(words: Column) -> Column:
    """The words of every tenth text from some place on replaced by a repetition of their beginning."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n, g = F.size(words).cast("long"), F.floor(h / 10).cast("long")
    a = F.when((h % 10 == 0) & (n > 0), g % n)
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    changed = let(
        F.struct(words.alias("w"), a.alias("a"), p.alias("p")),
        lambda v: F.transform(
            v["w"], lambda x, i: F.when(i >= v["a"], F.get(v["w"], (v["a"] + (i - v["a"]) % v["p"]).cast("int"))).otherwise(x)
        ),
    )
    return F.when(a.isNotNull(), changed).otherwise(words)


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    words = F.filter(F.split(whole(F.col("text")), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    docs = table(spark, folder, "documents").select("doc_id", let(words, lambda w: F.concat_ws(" ", _repeating(w))).alias("text"))
    found = periodic.periodic_runs(docs)
    longest = F.get(F.array_sort(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"], r["length"].alias("length")))), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_longest.start").alias("start"),
        F.col("_longest.length").alias("length"),
        F.col("_longest.period").alias("period"),
        F.floor(1000 * F.col("_longest.length") / F.col("_longest.period")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
