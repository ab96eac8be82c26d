"""Spelling variants: words one edit apart, found where their permuterm rotations share a prefix range.

A word marked by a terminator is turned round at each of its places, and the rotations are sorted. Skip
the character that a rotation ends with: words that differ in that character alone have the same rest, so
they stand in one prefix range. A word that lacks the character has this rest as a whole rotation and
stands in the same range. So replacements and indels at any place are found by one scan of the groups, and
no pair is compared.

A range holds one word for each skipped character and one for none, so its size is bounded by the alphabet
however often words occur, and each member learns the number and the weightiest of its neighbours from the
range alone. An indel inside a run of equal characters could be found at each place of the run; only the
first counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseline.llm.common import whole, written

#: The letters of a word, and the letters that are lowered.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Ends a word in its rotations; no letter.
END = "$"
MIN_LENGTH = 6
MIN_COUNT = 5
#: A form occurs so many times as often as the word that it corrects.
RATIO = 5


def word_counts(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    edit: Callable[[Column], Column] = lambda word: word,
) -> DataFrame:
    """``word`` and ``n``, the occurrences of every frequent word in the texts of ``docs``.

    Words are maximal runs of letters, with A-Z lowered. ``edit`` may change a word by an expression that
    sees the columns of ``docs``; it must not lengthen it. Null texts have no words.
    """
    lowered = F.translate(whole(F.col("text")), UPPER, LOWER)
    runs = F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    found = docs.withColumn("_run", F.explode(runs)).select(edit(F.col("_run")).alias("word"))
    counted = found.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """Every rotation of every word as (range, skipped, n): with its last character skipped, and whole."""
    word, places = F.col("word"), F.char_length("word")

    def turned(i: Column, start: Column) -> Column:
        return F.concat(F.substring(word, start + 1, places), F.lit(END), F.substring(word, F.lit(1), i))

    skipping = F.transform(
        F.sequence(F.lit(0), places - 1),
        lambda i: F.struct(turned(i, i + 1).alias("range"), F.substring(word, i + 1, F.lit(1)).alias("skipped")),
    )
    complete = F.transform(
        F.sequence(F.lit(0), places), lambda i: F.struct(turned(i, i).alias("range"), F.lit("").alias("skipped"))
    )
    return words.select("n", F.inline(F.concat(skipping, complete))).select("range", "skipped", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """Per word and prefix range with a neighbour: ``word``, ``n_near`` and ``best``, the neighbour of largest n
    (ties: smallest) as a struct of -n and word. Each pair of neighbours meets in one range alone."""
    ranges = rotations(words).groupBy("range").agg(F.collect_list(F.struct("skipped", "n")).alias("held")).where(F.size("held") > 1)
    back, front = F.substring_index("range", END, 1), F.substring_index("range", END, -1)

    def member(x: Column) -> Column:
        skipped = x["skipped"]
        return F.struct(
            (-x["n"]).alias("minus"),
            F.concat(front, skipped, back).alias("word"),
            (skipped == "").alias("whole"),
            ((skipped != "") & ~F.endswith(front, skipped)).alias("first"),
        )

    def near(x: Column) -> Column:
        mine = F.filter(
            "members",
            lambda y: (y["word"] != x["word"])
            & ((~x["whole"] & ~y["whole"]) | (x["whole"] & y["first"]) | (x["first"] & y["whole"])),
        )
        return F.struct(
            x["word"].alias("word"),
            (-x["minus"]).alias("n"),
            F.size(mine).cast("long").alias("n_near"),
            F.struct(F.get(mine, F.lit(0))["minus"].alias("minus"), F.get(mine, F.lit(0))["word"].alias("word")).alias("best"),
        )

    placed = ranges.select(F.array_sort(F.transform("held", member)).alias("members"))
    return placed.select(F.inline(F.transform("members", near))).where("n_near > 0")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of ``words`` (word, n): ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    Two words are near if one inserted, deleted or replaced character turns one into the other. The form
    of a word is its near word of largest n (ties: smallest in code-point order) if that n is at least
    ``ratio`` times its own, else null; the root is what following forms leads to, the word itself if it has
    none. Words that hold the terminator, null words and null counts are left out; repeated words add up.
    An empty table gives an empty result.
    """
    usable = words.where(F.col("word").isNotNull() & F.col("n").isNotNull() & ~F.contains("word", F.lit(END)) & (F.col("word") != ""))
    counts = written(usable.groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words")
    nothing = F.struct(F.lit(None).cast("long").alias("minus"), F.lit(None).cast("string").alias("word"))
    alone = counts.select("word", "n", F.lit(0).cast("long").alias("n_near"), nothing.alias("best"))
    known = neighbours(counts).unionByName(alone).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(F.when(F.col("best.word").isNotNull(), F.col("best"))).alias("best")
    )
    enough = -F.col("best.minus") >= ratio * F.col("n")
    formed = written(
        known.select(
            "word", "n", "n_near", F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n")
        ),
        "forms",
    )
    ends = roots(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for every word that has a form: chains are halved until each ends.

    Each step multiplies n, so chains have no cycles and their length is bounded by the logarithm of the
    largest n. Every round is written, so lineage stays short.
    """
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        joined = written(
            at.join(ahead, "root", "left").select("word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("moved")),
            "roots",
        )
        at = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            return at
