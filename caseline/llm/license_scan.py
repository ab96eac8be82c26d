"""License scans: an exact set-similarity join of text blocks with license templates.

Tokens are ordered by how many documents hold them, rarest first. A block that holds the threshold
share of a template must hold one of the template's first tokens in that order (prefix filter), must
have enough tokens (length filter), and must have enough left after the first common token in both
orders (positional filter). Blocks that pass are verified on their whole token sets, so every block
that reaches the threshold is found and no other.

A block is a window of ``SPREAD`` times the template's words over the word sequence of the whole text,
whatever its line breaks. The filters run on the token set of the text, which holds those of all its
windows; then windows are verified. Licenses of one family share nearly all words of their notices, so a
window must also hold the words that decide between them, one after the other. Beside the join, base phrases are found word by word.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseline.llm.common import let, whole
from caseline.operators.joins import bounded

# What separates words before and after ASCII letters are lowered, phrases and labels.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Notices as their licenses' stewards and the usual headers word them, by label, or by label/wording where a
#: license has several. Each goes down to what tells it from its relatives.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit": "Released under the MIT License",
    "mit/grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2",
    "gpl-2.0/header": "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-3.0/header": "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    "lgpl-2.1": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
    "lgpl-3.0": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
    "agpl-3.0": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-nc-nd-4.0": "Licensed under CC BY-NC-ND 4.0",
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0",
    "cc-by-sa-4.0/short": "Licensed under CC BY-SA 4.0",
    "cc-by-4.0/name": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0/name": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-nc-nd-4.0/name": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    "cc-by-nc-sa-4.0/name": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "cc-by-nd-4.0/name": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "bsd-3-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}
#: Phrases that a window must hold, each with its words one after the other: what tells a license from its
#: relatives, which share nearly all other words. Their words are words of the notice.
DECIDING = {
    "apache-2.0": ("Apache License Version 2.0",),
    "mit": ("MIT License",),
    "gpl-2.0": ("GNU General Public License version 2",),
    "gpl-2.0/header": ("GNU General Public License", "either version 2 of the License"),
    "gpl-3.0": ("GNU General Public License version 3",),
    "gpl-3.0/header": ("GNU General Public License", "either version 3 of the License"),
    "lgpl-2.1": ("GNU Lesser General Public License", "either version 2.1 of the License"),
    "lgpl-3.0": ("GNU Lesser General Public License", "either version 3 of the License"),
    "agpl-3.0": ("GNU Affero General Public License", "either version 3 of the License"),
    "cc-by-4.0": ("CC BY 4.0",),
    "cc-by-nc-4.0": ("CC BY-NC 4.0",),
    "cc-by-nc-nd-4.0": ("CC BY-NC-ND 4.0",),
    "cc-by-nc-sa-4.0": ("CC BY-NC-SA 4.0",),
    "cc-by-nd-4.0": ("CC BY-ND 4.0",),
    "cc-by-sa-4.0/short": ("CC BY-SA 4.0",),
    "cc-by-4.0/name": ("Attribution 4.0",),
    "cc-by-nc-4.0/name": ("Attribution-NonCommercial 4.0",),
    "cc-by-nc-nd-4.0/name": ("Attribution-NonCommercial-NoDerivatives 4.0",),
    "cc-by-nc-sa-4.0/name": ("Attribution-NonCommercial-ShareAlike 4.0",),
    "cc-by-nd-4.0/name": ("Attribution-NoDerivatives 4.0",),
    "cc-by-sa-4.0": ("Attribution-ShareAlike 4.0",),
    "cc0-1.0": ("CC0 1.0",),
    "mpl-2.0": ("Mozilla Public License v 2.0",),
}
THRESHOLD = 0.9
#: Words of a window for each word of the template: notices may have as many other words between theirs.
SPREAD = 2


def words_of(text: Column) -> Column:
    """Words of a text as they stand, not lowered."""
    return F.array_remove(F.split(text, GAP, -1), "")


def lowered(words: Column) -> Column:
    """Words with A-Z lowered and no other letter changed."""
    return F.split(F.translate(F.array_join(words, " "), CAPITALS, SMALL), " ", -1)


def _template_rows(docs: DataFrame, templates: Mapping[str, str]) -> DataFrame:
    made = docs.sparkSession.createDataFrame(list(templates.items()), T.StructType([
        T.StructField("label", T.StringType()), T.StructField("template", T.StringType())]))
    words = lowered(words_of(F.col("template")))
    return made.select("label", F.array_distinct(words).alias("tokens"), (SPREAD * F.size(words)).alias("window")).where(
        F.array_join("tokens", "") != ""
    )


def ranked_templates(docs: DataFrame, templates: Mapping[str, str], threshold: float, text: str = "text") -> DataFrame:
    """(label, window, tokens in global order, need, prefix): frequencies are counted over all documents.

    Only tokens of the templates can be common, so only those are counted; the result has one row per
    template.
    """
    rows = _template_rows(docs, templates)
    wanted = [r["t"] for r in rows.select(F.explode("tokens").alias("t")).distinct().collect()]  # bounded by the templates
    wanted = F.array(*[F.lit(t) for t in sorted(wanted)])
    # only few letters beyond A-Z lower to ASCII, which moves a frequency at most, never a match
    held = F.array_intersect(words_of(F.lower(whole(F.col(text)))), wanted)
    counts = docs.select(F.explode(held).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    size = F.size("tokens")
    need = F.ceil(size * F.lit(threshold) - 1e-9).cast("int")
    ranked = (
        rows.select("label", "window", F.explode("tokens").alias("token"))
        .join(counts, "token", "left")
        .groupBy("label", "window")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token"))).alias("r"))
        .select("label", "window", F.col("r.token").alias("tokens"))
    )
    return ranked.select("label", "window", "tokens", need.alias("need"), F.slice("tokens", F.lit(1), size - need + 1).alias("prefix"))


def license_blocks(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    text: str = "text",
    deciding: Mapping[str, Sequence[str]] = DECIDING,
) -> DataFrame:
    """Rows (key columns, block, label, containment): the best window of each text for each template it holds.

    Only windows with all deciding phrases of the template count. ``label`` is the template's name.

    ``docs`` has ``doc_id``, ``th`` and the text. ``block`` is the window's first word, counted from 0; of
    equally good windows it is the first.
    """
    ranked = [r.asDict() for r in ranked_templates(docs, templates, threshold, text).collect()]  # one row per template
    if not ranked:
        return docs.select("doc_id", "th", F.lit(0).alias("block"), F.lit("").alias("label"), F.lit(0.0).alias("containment")).limit(0)
    # the global order as one list: ranks of template tokens by frequency, rarest first
    spark = docs.sparkSession
    every = sorted({t for r in ranked for t in r["tokens"]})
    alphabet = F.array(*[F.lit(t) for t in every])
    starts = F.array(*[F.lit(t) for t in sorted({t for r in ranked for t in r["prefix"]})])
    fewest = min(r["need"] for r in ranked)
    # what lowers to a token in full also does so by A-Z alone or drops out below, so whole texts without
    # any first token go before anything is lowered exactly
    low = F.lower(whole(F.col(text)))
    tokens = sorted({t for r in ranked for t in r["prefix"]})
    some = functools.reduce(lambda x, y: x | y, [F.contains(low, F.lit(t)) for t in tokens])
    blocks = docs.where(some).select("doc_id", "th", words_of(F.translate(whole(F.col(text)), CAPITALS, SMALL)).alias("words"))
    blocks = blocks.withColumn("held", F.array_intersect("words", alphabet)).where(F.size("held") >= fewest)
    blocks = blocks.withColumn("firsts", F.array_intersect("held", starts)).where(F.size("firsts") > 0)
    index = spark.createDataFrame(
        [
            (r["label"], r["window"], r["tokens"], r["need"], [_low_words(p) for p in deciding.get(r["label"], ())], t)
            for r in ranked
            for t in r["prefix"]
        ],
        "label string, window int, tokens array<string>, need int, deciding array<array<string>>, first string",
    )
    candidates = blocks.withColumn("first", F.explode("firsts")).join(bounded(index), "first").where(
        F.size("held") >= F.col("need")
    )
    # both sides in global order: after the first common token, enough must be left in each
    candidates = candidates.withColumn("common", F.array_intersect("tokens", "held"))
    at = F.array_position("tokens", F.col("first"))
    candidates = candidates.where((F.col("common")[0] == F.col("first")) & (F.size("tokens") - at + 1 >= F.col("need")))
    found = candidates.where(F.size("common") >= F.col("need"))
    found = found.withColumn("best", _best_window(*map(F.col, ("words", "tokens", "need", "window", "deciding"))))
    found = found.where(F.col("best.n") >= F.col("need"))
    share = F.col("best.n") / F.size("tokens")
    return found.select("doc_id", "th", (-F.col("best.back")).alias("block"), "label", share.alias("containment"))


def _low_words(phrase: str) -> list[str]:
    return [w.translate(str.maketrans(CAPITALS, SMALL)) for w in re.split(GAP, phrase) if w]


def _best_window(words: Column, tokens: Column, need: Column, window: Column, deciding: Column) -> Column:
    """(n, back): most distinct tokens in a window that holds ``need`` and all phrases of ``deciding``, and
    minus its first word; null if there is none.

    Windows start at tokens: any other one is no better than that from its first token on.
    """

    def best(hits: Column) -> Column:
        def one(h: Column, k: Column) -> Column:
            # the ``need``-th token from here on must still lie in the window
            full = F.coalesce(F.get(hits, k + need - 1)["i"] < h["i"] + window, F.lit(False))
            end = h["i"] + window
            inside = F.filter(F.slice(hits, k + 1, window), lambda x: x["i"] < end)

            def rated(held: Column) -> Column:
                phrases = F.forall(
                    F.transform(deciding, lambda p, j: F.exists(held, lambda x: F.get(x["d"], j) & (x["i"] + F.size(p) <= end))),
                    lambda there: there,
                )
                n = F.size(F.array_distinct(F.transform(held, lambda x: x["t"])))
                return F.when(phrases, F.struct(n.alias("n"), (-h["i"]).alias("back")))

            return F.when(full, let(inside, rated))

        return F.array_max(F.transform(hits, one))

    # of each token: its number, its place, and which phrases start there
    starts = lambda i: F.transform(deciding, lambda p: F.slice(words, i + 1, F.size(p)) == p)
    placed = F.filter(
        F.transform(words, lambda w, i: F.struct(F.array_position(tokens, w).cast("int").alias("t"), i.alias("i"))),
        lambda x: x["t"] > 0,
    )
    marked = F.transform(placed, lambda x: F.struct(x["t"].alias("t"), x["i"].alias("i"), starts(x["i"]).alias("d")))
    return let(marked, best)


def _places(words: Column, phrase: list[str]) -> Column:
    """Starts of the phrase among ``words``, from 0."""
    count = F.size(words) - len(phrase)

    def here(i: Column) -> Column:
        found = F.get(words, i) == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            found = found & (F.get(words, i + k) == word)
        return found

    return F.when(count >= 0, F.filter(F.sequence(F.lit(0), count), here)).otherwise(F.array().cast("array<int>"))


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    text: str = "text",
    deciding: Mapping[str, Sequence[str]] = DECIDING,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, places of the base phrases, labels and score.

    Columns: n_words; n_base, all places; first_word and last_word, their smallest and largest start
    (null without one); base_labels and labels, distinct, sorted and comma-joined; score, the largest
    containment of a template in a window of words that holds its deciding phrases, and 1 where a base phrase stands.

    Null and empty texts have no words and no labels. Null ids are ids like others, repeated rows are
    repeated, other columns are ignored, an empty table gives an empty result.
    """
    body = whole(F.col(text))
    gap = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    maybe = body.rlike("(?i)" + "|".join(gap.join(p.split(" ")) for p in phrases))
    none = F.array().cast("array<int>")

    def summary(w: Column) -> Column:
        def of(low: Column) -> Column:
            return F.struct(*[_places(low, p.split(" ")).alias(f"p{i}") for i, p in enumerate(phrases)])

        empty = F.struct(*[none.alias(f"p{i}") for i in range(len(phrases))])
        return F.struct(F.size(w).cast("long").alias("n_words"), F.when(maybe, let(lowered(w), of)).otherwise(empty).alias("p"))

    base = docs.select("doc_id", F.xxhash64(text).alias("th"), let(words_of(body), summary).alias("s"))
    starts = F.concat(*[F.col(f"s.p.p{i}") for i in range(len(phrases))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"s.p.p{i}") > 0, F.lit(v)) for i, v in enumerate(phrases.values())]))
    base = base.select(
        "doc_id",
        "th",
        F.col("s.n_words").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(labels)).alias("_base"),
    )
    blocks = license_blocks(docs.select("doc_id", F.xxhash64(text).alias("th"), F.col(text)), templates, threshold, text, deciding)
    more = blocks.groupBy("doc_id", "th").agg(
        F.collect_set(F.substring_index("label", "/", 1)).alias("_more"), F.max("containment").alias("_score")  # at most one label per template
    )
    more = more.withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    joined = base.join(more, base["doc_id"].eqNullSafe(more["_id"]) & (base["th"] == more["_th"]), "left")
    both = F.array_sort(F.array_union("_base", F.coalesce("_more", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_score", F.lit(0.0))).alias("score"),
    )
