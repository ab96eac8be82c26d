"""Personal data: base patterns, and identifiers found by bootstrapped contextual extraction.

Base spans are the seeds. Runs of tokens with digits are candidates. Each has its lexical context: the
word before it and the sign that opens it. A context that mostly holds known identifiers becomes a
pattern, the candidates in it become known in turn, and so on until no new pattern appears. Contexts and
identifiers form a graph whose scores Spark aggregates; candidates that a trusted pattern holds are added
to the spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseline.llm.common import let, whole, written

# The base patterns in the order of their kinds, and their limits.
KINDS = ("email", "ip", "card", "phone")
CARD_DIGITS = (12, 19)
PHONE_DIGITS = (9, 15)

_LOCAL = r"A-Za-z0-9._%+-"
#: A match starts where the last one ended or where no character of its own class stands before it;
#: other starts cannot match, and trying them would take quadratic time on long runs.
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Single separators between digits become this sign first, so that a run is one class of characters.
JOINT = "\ue000"
CARD = rf"[0-9][0-9{JOINT}]++"

CONTEXT = 40
MIN_KNOWN = 3
CONFIDENCE = 0.8
#: A candidate: tokens of these, each with a digit, and single blanks between letters or digits of them; at
#: least ``SHORTEST`` characters. Tokens start where none stands before, and nothing is tried twice.
_SIGN = r"A-Za-z_@.+%\-"
_TOKEN = rf"[{_SIGN}]*+[0-9][{_SIGN}0-9]*+"
TOKENS = rf"(?<![{_SIGN}0-9]){_TOKEN}(?:(?<=[A-Za-z0-9])[\x20\u00a0](?=[A-Za-z0-9]){_TOKEN})*+"
SHORTEST = 6
#: Code points of the pieces that texts are cut into to look places up.
PIECE = 1024
#: Stands for each character of a base span while candidates are searched.
MASK = "\ue000"
ADDED = "id"


def running(values: Column) -> Column:
    """Running sums of an array of integers, itself included.

    Arrays can only grow by copying, so sums run inside blocks of about the root of the length, and the
    blocks' totals run over the blocks: for n values n to the power of 1.5 steps, not n squared.
    """
    none = F.array().cast("array<int>")

    def sums(v: Column) -> Column:
        last = lambda acc: F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0))
        return F.aggregate(v, none, lambda acc, x: F.concat(acc, F.array((last(acc) + x).cast("int"))))

    def joined(blocks: Column) -> Column:
        before = sums(F.transform(blocks, lambda b: F.get(b, F.size(b) - 1)))
        return let(
            before,
            lambda t: F.flatten(F.transform(blocks, lambda b, i: F.transform(b, lambda x: (x + F.coalesce(F.get(t, i - 1), F.lit(0))).cast("int")))),
        )

    def of(v: Column) -> Column:
        n = F.size(v)
        width = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(16))
        firsts = F.sequence(F.lit(0), n - 1, width)
        return F.when(n == 0, none).otherwise(let(F.transform(firsts, lambda a: sums(F.slice(v, a + 1, width))), joined))

    return let(values, of)


def pieces(text: Column) -> Column:
    """``text`` in pieces of ``PIECE`` code points, the last one shorter."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut(held: Column, start: Column, length: Column) -> Column:
    """``length`` code points from place ``start`` on, out of ``pieces``: the text before is not walked."""
    first = F.floor(start / PIECE).cast("int")
    number = F.floor((start + length) / PIECE).cast("int") - first + 1
    return F.substring(F.array_join(F.slice(held, first + 1, number), ""), start - first * PIECE + 1, length)


SPAN = "array<struct<start:int,end:int,value:string,left:string,right:string>>"


def spans(text: Column, pattern: str) -> Column:
    """Matches as an array of (start, end, value, left, right), in code points, end exclusive; ``left`` and
    ``right`` are the characters beside the match, empty at the ends and between neighbouring matches.

    What stands between the matches and the matches themselves give the places.
    """

    def placed(gaps: Column, found: Column) -> Column:
        sizes = F.transform(found, lambda v, i: F.char_length(F.get(gaps, i)) + F.char_length(v))
        return let(
            running(sizes),
            lambda ends: F.transform(
                found,
                lambda v, i: F.struct(
                    (F.get(ends, i) - F.char_length(v)).alias("start"),
                    F.get(ends, i).alias("end"),
                    v.alias("value"),
                    F.right(F.get(gaps, i), F.lit(1)).alias("left"),
                    F.left(F.get(gaps, i + 1), F.lit(1)).alias("right"),
                ),
            ),
        )

    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) == 0, F.array().cast(SPAN)).otherwise(
            let(F.split(text, pattern, -1), lambda gaps: placed(gaps, found))
        ),
    )


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the checksum holds: from the right, every second digit doubles and 9 goes off above 9."""
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


def base_spans(body: Column) -> Column:
    """All base spans as an array of (start, kind number, end), unordered. Failing matches go, with no retry."""
    none = F.array().cast(SPAN)

    def part_ok(value: Column) -> Column:
        return F.forall(
            F.split(value, r"\.", -1),
            lambda p: let(
                F.regexp_replace(p, "^0+", ""), lambda q: (F.length(q) <= 3) & (F.coalesce(F.when(F.length(q) <= 3, q.try_cast("int")), F.lit(0)) <= 255)
            ),
        )

    def length_in(value: Column, limits: tuple[int, int]) -> Column:
        return F.length(digits_of(value)).between(*limits)

    joined = F.regexp_replace(F.regexp_replace(body, JOINT, "\ue001"), r"(?<=[0-9])[\x20-](?=[0-9])", JOINT)
    card_ok = lambda s: F.when(length_in(s["value"], CARD_DIGITS), luhn(digits_of(s["value"]))).otherwise(False)
    found = [
        F.when(F.contains(body, F.lit("@")), spans(body, EMAIL)).otherwise(none),
        F.filter(F.when(body.rlike(r"[0-9]\.[0-9]"), spans(body, IP)).otherwise(none), lambda s: part_ok(s["value"])),
        F.filter(F.when(body.rlike(r"[0-9][\x20-]?[0-9]"), let(joined, lambda j: spans(j, CARD))).otherwise(none), card_ok),
        F.filter(
            F.when(F.contains(body, F.lit("+")), spans(body, PHONE)).otherwise(none),
            lambda s: length_in(s["value"], PHONE_DIGITS),
        ),
    ]

    def of_kind(k: int) -> Column:
        return F.transform(found[k], lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))

    return F.concat(*[of_kind(k) for k in range(len(KINDS))])


def listed(found: Column, names: tuple[str, ...]) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    name = F.array(*[F.lit(n) for n in names])
    return F.array_join(
        F.transform(F.array_sort(found), lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def masked(held: Column, base: Column) -> Column:
    """The text of the pieces ``held`` with the base spans blanked out, places unchanged.

    Spans of one kind do not overlap, but those of two kinds may; a span inside those before it has nothing
    left to blank out. Starts and ends sorted each by itself give the stretches that no span covers: one
    begins with the k-th end if no more than k spans have started by then.
    """

    def stretches(starts: Column, ends: Column) -> Column:
        # where k spans have ended and the next one starts, all that started have ended
        open_ = F.filter(
            F.transform(ends, lambda e, k: F.struct(e.alias("at"), F.get(starts, k + 1).alias("to"))),
            lambda g: g["to"].isNull() | (g["to"] >= g["at"]),
        )
        return F.concat(F.array(F.struct(F.lit(0).alias("at"), F.get(starts, F.lit(0)).alias("to"))), open_)

    def text_of(free: Column) -> Column:
        whole_end = F.aggregate(held, F.lit(0), lambda n, p: n + F.char_length(p))

        def part(g: Column, i: Column) -> Column:
            end = F.coalesce(g["to"], whole_end)
            after = F.coalesce(F.get(free, i + 1)["at"], end)
            return F.concat(cut(held, g["at"], end - g["at"]), F.repeat(F.lit(MASK), after - end))

        return F.array_join(F.transform(free, part), "")

    starts = F.array_sort(F.transform(base, lambda b: b["start"]))
    ends = F.array_sort(F.transform(base, lambda b: b["end"]))
    return F.when(F.size(base) == 0, F.array_join(held, "")).otherwise(
        let(F.struct(starts.alias("s"), ends.alias("e")), lambda v: let(stretches(v["s"], v["e"]), text_of))
    )


def candidates(marked: DataFrame) -> DataFrame:
    """Instances (doc_id, th, start, end, value, context, seed): every base span, and the candidates beside them.

    The context is the last word before the instance, its digits as 0, and the signs between them, taken
    from the ``CONTEXT`` characters before it. ``seed`` tells base spans. Candidates that touch one are none.
    Contexts are cut inside the row, so that no text goes along with its instances.
    """
    body = F.col("body")

    def instances(held: Column) -> Column:
        def instance(s: Column, value: Column, seed: bool) -> Column:
            before = cut(held, F.greatest(s["start"] - CONTEXT, F.lit(0)), F.least(s["start"], F.lit(CONTEXT)))
            context = F.regexp_replace(F.lower(F.regexp_extract(before, r"(\S*[\s]*[^\p{L}\p{N}\s]*)$", 1)), "[0-9]", "0")
            return F.struct(
                s["start"].alias("start"), s["end"].alias("end"), F.xxhash64(F.lower(value)).alias("value"),
                F.trim(context).alias("context"), F.lit(seed).alias("seed"),
            )

        seeds = F.transform("base", lambda b: instance(b, cut(held, b["start"], b["end"] - b["start"]), True))
        more = F.filter(
            let(masked(held, F.col("base")), lambda open_: spans(open_, TOKENS)),
            lambda s: (s["end"] - s["start"] >= SHORTEST) & (s["left"] != MASK) & (s["right"] != MASK),
        )
        return F.concat(seeds, F.transform(more, lambda s: instance(s, s["value"], False)))

    held = marked.where((F.size("base") > 0) | body.rlike("[0-9]"))
    return held.select("doc_id", "th", F.explode(let(pieces(body), instances)).alias("s")).select(
        "doc_id", "th", "s.start", "s.end", "s.value", "s.context", "s.seed"
    ).where(F.col("context") != "")


def trusted(tokens: DataFrame, confidence: float = CONFIDENCE, min_known: int = MIN_KNOWN) -> DataFrame:
    """Contexts that hold known identifiers: at least ``min_known`` different ones, and ``confidence`` of all.

    Known are the seeds at first, then also what trusted contexts hold. What is known only grows, so
    patterns do too, and the rounds end when no context is added.
    """
    edges = written(tokens.groupBy("context", "value").agg(F.max("seed").alias("seed")), "pii-edges")
    known = edges.groupBy("value").agg(F.max(F.col("seed").cast("int")).alias("known"))
    count = 0
    while True:
        scored = (
            edges.select("context", "value").join(known, "value")
            .groupBy("context")
            .agg(F.sum("known").alias("hits"), F.count(F.lit(1)).alias("all"))
        )
        patterns = written(
            scored.where((F.col("hits") >= min_known) & (F.col("hits") >= F.col("all") * confidence)).select("context"), "pii-patterns"
        )
        before, count = count, patterns.count()
        if count == before:
            return patterns
        reached = edges.join(patterns, "context", "left_semi").select("value").distinct().withColumn("more", F.lit(1))
        known = written(
            known.join(reached, "value", "left").select("value", F.greatest("known", F.coalesce("more", F.lit(0))).alias("known")),
            "pii-known",
        )


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, spans by kind, a digest of the base spans, and all spans.

    Columns: n_email, n_ip, n_card, n_phone; base_sha256 over ``kind:start:end`` by start and kind;
    spans, the base spans and those of kind ``id`` that the bootstrapping adds where no base span lies.

    Null and empty texts have no spans. Null ids are ids like others, repeated rows are repeated, other
    columns are ignored, an empty table gives an empty result.
    """
    body = whole(F.col(text))
    marked = docs.select("doc_id", F.xxhash64(text).alias("th"), body.alias("body"), base_spans(body).alias("base"))
    marked = written(marked, "pii-base")
    tokens = written(candidates(marked), "pii-tokens")
    new = tokens.where(~F.col("seed")).join(trusted(tokens), "context", "left_semi")
    added = new.groupBy("doc_id", "th").agg(
        F.collect_set(F.struct("start", F.lit(len(KINDS)).alias("kind"), "end")).alias("added")  # spans of one text
    )
    added = added.withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    joined = marked.select("doc_id", "th", "base").join(
        added, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left"
    )

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")

    every = F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    return joined.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(listed(F.col("base"), KINDS), 256).alias("base_sha256"),
        listed(every, (*KINDS, ADDED)).alias("spans"),
    )
