"""Quotation linking: quoted passages are joined to the messages that they quote.

A message's lines are parsed into quote levels by their leading marks. Passages, runs of lines of one
level, are normalised and hashed; a message offers the passages that it wrote itself. A quoted passage
links to the first message of its conversation that wrote it earlier; where nobody wrote the whole
passage, its lines and pairs of neighbouring lines are looked up instead, so that trimmed quotations
link too. The outermost quotation names the
message replied to. Conversations are put in reply order, their texts without quotes.

Messages of a conversation are never gathered: passages meet by conversation and hash after each hash
has been reduced to its first writer, and the depth of replies comes from pointer jumping.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseline.llm.common import let, whole, written

#: Quote marks that a line starts with, each with a blank or none after it.
MARKS = re.compile(r"[ \t]*((?:>[ \t]?)*)")
#: A line that only introduces a quotation.
INTRO = r"(?i)^\s*(on .{0,200}wrote:|.{0,100} (wrote|schrieb|a écrit|escribió) ?:)\s*$"


def normalised(text: Column) -> Column:
    """Lower case, runs of blanks as one, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def hashed(text: Column) -> Column:
    """16 bytes that stand for a passage."""
    return F.unhex(F.md5(text))


def runs_of(text: str) -> list[tuple[int, str]]:
    """(level, body) of each run of lines with equally many quote marks, the marks off."""
    runs: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        lead = MARKS.match(line)
        level = lead[1].count(">")
        line = line[lead.end() :] if level else line
        if runs and runs[-1][0] == level:
            runs[-1][1].append(line)
        else:
            runs.append((level, [line]))
    return [(level, "\n".join(lines)) for level, lines in runs]


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, th, at, level, body, hash): the runs of every message, counted by ``at``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [
                (conv, turn, th, at, level, body)
                for conv, turn, th, text in zip(b["conv_id"], b["turn"], b["th"], b["text"])
                for at, (level, body) in enumerate(runs_of(text))
            ]
            frame = pd.DataFrame(out, columns=["conv_id", "turn", "th", "at", "level", "body"])
            yield frame.astype({"conv_id": b["conv_id"].dtype, "turn": b["turn"].dtype}) if out else frame

    held = messages.select("conv_id", "turn", F.xxhash64("text").alias("th"), whole(F.col("text")).alias("text"))
    types = ", ".join(f"{c} {held.schema[c].dataType.simpleString()}" for c in ("conv_id", "turn", "th"))
    out = held.mapInPandas(run, f"{types}, at int, level int, body string")
    text = normalised(F.col("body"))
    return out.withColumn("hash", F.when(text != "", hashed(text)))


def lines_of(text: Column) -> Column:
    """The normalised lines of a text, without blank ones and those that introduce a quotation."""
    kept = F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike(INTRO))
    return F.filter(F.transform(kept, normalised), lambda x: x != "")


def units_of(lines: Column) -> Column:
    """(pair, k, hash) of each line and of each pair of neighbouring lines; a line hashes as a passage does.

    The lines must be bound by ``let``, as every unit reads them.
    """
    one = F.transform(lines, lambda x, k: F.struct(F.lit(0).alias("pair"), k.alias("k"), hashed(x).alias("hash")))
    two = F.transform(
        F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))),
        lambda x, k: F.struct(F.lit(1).alias("pair"), k.alias("k"), hashed(F.concat(F.get(lines, k), F.lit("\n"), x)).alias("hash")),
    )
    return F.concat(one, two)


def _trimmed(left: DataFrame, first: DataFrame) -> DataFrame:
    """(conv_id, turn, th, at, part): the sources of quoted runs ``left`` over, by their lines.

    If all pairs of a run have a source, the latest of these is it: one message that wrote all of them is
    no earlier than the first writer of any. Otherwise consecutive units of one source are joined and the
    longest stretch decides, the latest source among equals; single lines count where no pair is linked.
    """
    units = left.withColumn("lines", lines_of(F.col("body"))).where(F.size("lines") > 0)
    units = units.select("conv_id", "turn", "th", "at", F.explode(let(F.col("lines"), units_of)).alias("u"))
    met = units.select("conv_id", "turn", "th", "at", "u.pair", "u.k", "u.hash").join(
        first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("hash") == F.col("_hash")) & (F.col("source") < F.col("turn")), "left"
    )
    found = met.groupBy("conv_id", "turn", "th", "at").agg(
        F.array_sort(F.collect_set(F.struct("pair", "k", "source"))).alias("units")  # of one run
    )

    def stretch(units: Column) -> Column:
        source = found.schema["units"].dataType.elementType["source"].dataType
        none = F.lit(None).cast(source)
        start = F.struct(none.alias("source"), F.lit(0).alias("n"), F.struct(F.lit(0).alias("n"), none.alias("source")).alias("best"))

        def step(acc: Column, u: Column) -> Column:
            n = F.when(u["source"].isNull(), 0).when(u["source"] == acc["source"], acc["n"] + 1).otherwise(1)
            here = F.struct(n.alias("n"), u["source"].alias("source"))
            return F.struct(u["source"].alias("source"), n.alias("n"), F.when(n > 0, F.greatest(acc["best"], here)).otherwise(acc["best"]).alias("best"))

        return F.aggregate(units, start, step, lambda acc: acc["best"]["source"])

    pairs = F.filter("units", lambda u: u["pair"] == 1)
    lines = F.filter("units", lambda u: u["pair"] == 0)
    sources = F.transform(pairs, lambda u: u["source"])
    every = (F.size(pairs) > 0) & F.forall(sources, lambda s: s.isNotNull())
    part = F.when(every, F.array_max(sources)).otherwise(F.coalesce(stretch(pairs), stretch(lines)))
    return found.select("conv_id", "turn", "th", "at", part.alias("part"))


def link(messages: DataFrame) -> DataFrame:
    """One row per row of ``messages`` (conv_id, turn, role, text), in reply order.

    Columns: conv_id, turn, role; reply_to, the turn of the first earlier message that wrote the first
    quoted passage of level 1 (null without a quotation or a source); n_quotes, quoted passages of all
    levels; n_linked, those with a source; root, the turn that the chain of replies starts at; depth,
    replies up to it; own_text, the text without quotations and the lines that introduce them. Rows come
    sorted by conv_id, root, depth and turn.

    A passage counts as written by a message if it stands there at level 0, or is one whole line or the
    whole own text of it. A passage that nobody wrote as such has a source if some of its lines do, see
    ``_trimmed``. Null and empty texts quote and write nothing. Null turns quote, but nobody
    quotes them, and they are roots. Rows with equal conv_id and turn are one source, and each is linked
    by its own text; rows equal in text as well have equal results. Null conversations are one conversation. Other columns are ignored. An empty table gives an empty
    result.
    """
    rows = messages.select("conv_id", "turn", "role", "text", F.xxhash64("text").alias("th"))
    # equal rows are one message, so that a message's runs are never gathered twice
    parts = written(passages(rows.dropDuplicates(["conv_id", "turn", "th"])), "passages")
    own = parts.where("level = 0").groupBy("conv_id", "turn", "th").agg(
        F.array_sort(F.collect_list(F.struct("at", "body"))).alias("runs")  # of one message
    )
    intro = F.filter(F.split(F.array_join(F.transform("runs", lambda r: r["body"]), "\n"), "\n", -1), lambda x: ~x.rlike(INTRO))
    own = own.select("conv_id", "turn", "th", F.trim(F.array_join(intro, "\n")).alias("own_text"))
    whole_own = own.select("conv_id", "turn", hashed(normalised(F.col("own_text"))).alias("hash"), F.lit("own_text").alias("_w"), "own_text")
    units = own.select("conv_id", "turn", F.explode(let(lines_of(F.col("own_text")), units_of)["hash"]).alias("hash"))
    wrote = (
        parts.where((F.col("level") == 0) & F.col("hash").isNotNull()).select("conv_id", "turn", "hash")
        .unionByName(whole_own.where(normalised(F.col("own_text")) != "").select("conv_id", "turn", "hash"))
        .unionByName(units)
    )
    first = wrote.where(F.col("turn").isNotNull()).groupBy("conv_id", "hash").agg(F.min("turn").alias("source"))
    first = written(first.withColumnsRenamed({"conv_id": "_conv", "hash": "_hash"}), "writers")
    quoted = parts.where((F.col("level") > 0) & F.col("hash").isNotNull())
    linked = quoted.join(
        first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("hash") == F.col("_hash")) & (F.col("source") < F.col("turn")), "left"
    )
    linked = written(linked.select("conv_id", "turn", "th", "at", "level", "body", "source"), "quoted")
    keys = ["conv_id", "turn", "th"]
    named = {k: f"_{k}" for k in [*keys, "at"]}
    part = _trimmed(linked.where("source IS NULL"), first).withColumnsRenamed(named)
    on = [linked[k].eqNullSafe(part[f"_{k}"]) for k in named]
    linked = linked.join(part, on, "left").withColumn("source", F.coalesce("source", "part")).drop(*named.values(), "part")
    per = linked.groupBy("conv_id", "turn", "th").agg(
        F.count(F.lit(1)).alias("n_quotes"),
        F.count("source").alias("n_linked"),
        F.min(F.when(F.col("level") == 1, F.struct("at", "source"))).alias("outer"),
        F.min(F.struct("level", "at", "source")).alias("any"),
    )
    per = per.select("conv_id", "turn", "th", "n_quotes", "n_linked", F.coalesce("outer.source", "any.source").alias("reply_to"))
    named = {k: f"_{k}" for k in keys}

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed(named)
        on = [left[k].eqNullSafe(right[f"_{k}"]) for k in keys]
        return left.join(right, on, "left").drop(*named.values())

    base = beside(beside(rows.drop("text"), own), per)
    base = written(base, "linked")
    depth = _depths(base.where(F.col("turn").isNotNull()).groupBy("conv_id", "turn").agg(F.min("reply_to").alias("up")))
    depth = depth.withColumnsRenamed({"conv_id": "_c", "turn": "_t"})
    out = base.join(depth, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("turn") == F.col("_t")), "left")
    return out.select(
        "conv_id",
        "turn",
        "role",
        "reply_to",
        F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.coalesce("root", "turn").alias("root"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.coalesce("own_text", F.lit("")).alias("own_text"),
    ).orderBy("conv_id", "root", "depth", "turn")


def _depths(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, root, depth) by pointer jumping: each round doubles the way known upwards.

    A parent is an earlier turn, so chains end; one that is no row ends a chain too. Turns whose root is
    known take no part in later rounds, so only long chains do.
    """
    none = F.col("up").isNull()
    now = written(
        parents.select("conv_id", "turn", F.coalesce("up", "turn").alias("root"), (~none).cast("long").alias("depth"), none.alias("done")),
        "depths",
    )
    while not now.where("NOT done").isEmpty():
        above = now.select(
            F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("root").alias("_r"), F.col("depth").alias("_d"), F.col("done").alias("_done")
        )
        climbing = now.where("NOT done").drop("done")
        climbed = climbing.join(above, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("root") == F.col("_t")), "left").select(
            "conv_id",
            "turn",
            F.coalesce("_r", "root").alias("root"),
            (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"),
            F.coalesce("_done", F.lit(True)).alias("done"),
        )
        now = written(now.where("done").unionByName(climbed), "depths")
    return now.drop("done")


def quoting(conversations: DataFrame) -> DataFrame:
    """``conversations`` as mail threads: each turn quotes the one before it, and that one's quotation one deeper.

    A turn's mail is an introduction, the quotation of the previous turn's mail down to two levels, and
    its own text. Every third turn trims the quotation of the previous turn by its first line, if three
    lines or more are there.
    """
    prev = conversations.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("one"))
    older = conversations.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("text").alias("two"))
    keys = ["conv_id", "turn"]
    # equal keys would multiply; the smallest text stands for them
    prev = prev.groupBy(*keys).agg(F.min("one").alias("one"))
    older = older.groupBy(*keys).agg(F.min("two").alias("two"))

    def marked(text: Column, mark: str) -> Column:
        return F.array_join(F.transform(F.split(text, "\n", -1), lambda x: F.concat(F.lit(mark), x)), "\n")

    def trimmed(text: Column) -> Column:
        cut = (F.col("turn") % 3 == 2) & (F.size(F.split(text, "\n", -1)) >= 3)
        return F.when(cut, F.regexp_replace(text, r"^[^\n]*\n", "")).otherwise(text)

    joined = conversations.select("conv_id", "turn", "role", "text").join(prev, keys, "left").join(older, keys, "left")
    mail = F.concat_ws(
        "\n",
        F.when(F.col("one").isNotNull(), F.lit("On the day before, they wrote:")),
        marked(F.col("two"), ">> "),
        marked(trimmed(F.col("one")), "> "),
        whole(F.col("text")),
    )
    return joined.select("conv_id", "turn", "role", mail.alias("text"))
