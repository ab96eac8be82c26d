"""Quality rules as a short-circuit cascade ordered by rejections per cost.

A rule is a rejecting condition with an estimate of the elementary steps it takes on a row. Rejections and
steps are added up on a sample, drawn row by row from the whole table; the cascade then runs the rule first that rejects most of what is left
per step, and a row stops at the first rule that rejects it. The order changes the cost alone: a row
is kept exactly if no rule rejects it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseline.llm.common import let, whole

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Expected rows of the sample that costs and selectivities are estimated on, and what draws them.
SAMPLE_ROWS = 2000
SAMPLE_SEED = 11


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true, false or null (null keeps); ``work`` counts the steps it takes on a row."""

    name: str
    rejects: Column
    work: Column


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK, -1), "")


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long"))


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur twice or more in the text.

    Windows are compared by a 64-bit hash. Most texts repeat none, which a distinct count shows; the
    others sort their windows by hash, keep the starts of those with an equal neighbour, and add up
    the words that these cover.
    """

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            last = F.size(s) - 1
            return F.array_sort(
                F.transform(
                    F.filter(
                        s,
                        lambda x, k: F.when(k > 0, x["h"] == F.get(s, k - 1)["h"]).otherwise(False)
                        | F.when(k < last, x["h"] == F.get(s, k + 1)["h"]).otherwise(False),
                    ),
                    lambda x: x["i"],
                )
            )

        def total(p: Column) -> Column:
            gaps = F.transform(
                p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window))).cast("long")
            )
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

        return let(let(placed, starts), total)

    def count(w: Column) -> Column:
        n = F.size(w)
        hashes = F.transform(F.sequence(F.lit(1), n - window + 1), lambda i: F.xxhash64(F.slice(w, i, window)))
        found = let(
            hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))
        )
        return F.when(n < window, F.lit(0).cast("long")).otherwise(found)

    return let(words, count)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base measures and ``base_failed``, a pure projection.

    Null and empty texts have no words and fail. Columns of the same names are replaced.
    """
    body = whole(F.col(text))
    held = "__quality_words"
    out = docs.withColumn(
        held,
        let(
            words_of(body),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                repeat_words(w).alias("n_repeat_words"),
            ),
        ),
    )
    for name in ("n_words", "word_chars", "n_repeat_words"):
        out = out.withColumn(name, F.col(f"{held}.{name}"))
    return (
        out.withColumn(
            "n_symbols", (F.char_length(body) - F.char_length(F.regexp_replace(body, SYMBOLS, ""))).cast("long")
        )
        .withColumn("n_dup_lines", dup_lines(body))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
        .drop(held)
    )


def most_frequent(words: Column) -> Column:
    """How often the word stands that makes up over half of ``words``; at most half if none does.

    In sorted order a word of over half covers the middle. Where it would need more repetitions than
    there are, nothing is sorted.
    """

    def middle(w: Column) -> Column:
        return let(F.get(F.sort_array(w), F.floor(F.size(w) / 2).cast("int")), lambda m: F.size(F.filter(w, lambda x: x == m)))

    most = F.size(words) - F.size(F.array_distinct(words)) + 1
    return F.when(2 * most > F.size(words), middle(words)).otherwise(F.lit(0))


def default_rules(text: str = "text") -> list[Rule]:
    """Rules that spare ordinary prose: each asks for what clean documents do not show.

    ``symbols``: over one symbol in ten word characters. ``one_word``: a single word makes up over
    half of 20 words or more. ``dup_lines``: over half of the lines repeat earlier ones.
    ``shouting``: over 70 % of the letters of any script are capitals in a text with more than 40 letters.
    """
    body = whole(F.col(text))
    n_words, n_chars = F.col("n_words"), F.char_length(body)
    upper = n_chars - F.char_length(F.regexp_replace(body, r"\p{Lu}+", ""))
    letters = n_chars - F.char_length(F.regexp_replace(body, r"\p{L}+", ""))
    top = let(words_of(body), most_frequent)
    lines = F.size(F.split(body, "\n", -1))
    return [
        Rule("base", F.col("base_failed"), F.lit(1)),
        Rule("symbols", 10 * F.col("n_symbols") > F.col("word_chars"), F.lit(1)),
        Rule("dup_lines", (2 * F.col("n_dup_lines") > lines) & (lines >= 4), n_chars),
        Rule("one_word", (n_words >= 20) & (2 * top > n_words), 8 * n_chars),
        Rule("shouting", (10 * upper > 7 * letters) & (letters > 40), 4 * n_chars),
    ]


def sampled(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Each row of ``docs`` with the same chance, ``rows`` expected in all; the whole of a smaller table.

    Rows are drawn one by one, wherever they lie, so neither a hot key nor the order of the files matters,
    and the number does not grow with the tasks. The draw reads the table once more and moves nothing.
    """
    total = docs.count()
    return docs if total <= rows else docs.sample(rows / total, SAMPLE_SEED)


def ordered(sample: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """The rules by rejections per step among what the earlier ones leave of the measured ``sample``.

    Tasks count their rows by the rules that reject them; only these counts are shuffled, and the driver
    gets one row per combination of rejecting rules. Rules that reject nothing there come last, the
    cheapest first.
    """
    names = [f"r{i}" for i in range(len(rules))]
    flags = [F.coalesce(r.rejects, F.lit(False)).alias(n) for n, r in zip(names, rules)]
    works = [r.work.cast("double").alias(f"w{i}") for i, r in enumerate(rules)]
    seen = (
        sample.select(*flags, *works)
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"w{i}").alias(f"w{i}") for i in range(len(rules))])
        .collect()
    )
    left, picked = list(range(len(rules))), []
    alive = list(seen)
    while left:

        def gain(i: int) -> tuple[float, float, int]:
            rejected = sum(row["n"] for row in alive if row[f"r{i}"])
            cost = sum(row[f"w{i}"] or 0.0 for row in alive)
            return (rejected / max(cost, 1.0), -cost, -i)

        best = max(left, key=gain)
        left.remove(best)
        picked.append(best)
        alive = [row for row in alive if not row[f"r{best}"]]
    return [rules[i] for i in picked]


def cascade(rules: Sequence[Rule]) -> Column:
    """True if no rule rejects the row; later rules are not evaluated once one has rejected it."""
    kept = None
    for r in rules:
        step = F.coalesce(r.rejects, F.lit(False))
        kept = F.when(step, F.lit(False)) if kept is None else kept.when(step, F.lit(False))
    return F.lit(True) if kept is None else kept.otherwise(F.lit(True))


def quality(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Every row of ``docs`` with its measures, ``base_failed`` and ``kept``.

    Null and empty texts fail the base rule. The order of the rules comes from about ``sample_rows`` rows. Repeated rows stay as they are. An empty table gives an
    empty result. Columns of ``docs`` named like a result are replaced.
    """
    rules = default_rules(text) if rules is None else list(rules)
    order = ordered(measures(sampled(docs, sample_rows), text), rules)
    return measures(docs, text).withColumn("kept", cascade(order))
