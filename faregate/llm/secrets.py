"""Secret scan: three fixed patterns, and windows of high Shannon entropy.

Each pattern's matches are found leftmost and non-overlapping over the whole
text; their places follow from the lengths of the matches and of what lies
between them, in characters. Matches that fail the pattern's length are dropped.

The entropy method looks at candidates, runs of 24 characters or more of
letters, digits and ``+/_=-``. A window of ``WINDOW`` characters slides over each
one; the counts of the window's characters, and the sum of n * log2(n) over them,
are kept up at two places, for the character that enters and the one that leaves.
A candidate whose highest window entropy reaches the threshold of its character
class is a span of kind ``entropy``. Classes: ``hex`` (only hex digits), ``alnum``
(letters and digits), ``base64`` (any). The allow-list suppresses candidates that are
no secrets: words joined by single signs, runs without a digit, numbers, UUIDs,
dates, and texts that say so (example, placeholder, dummy, xxxx). Spans that
overlap a pattern's span are left to the pattern.

A candidate may hold a name, path segments and a value. What makes it no span of
its own need not hold for all of it, so unless its shape is allow-listed as a
whole, it is looked at again in parts of 24 characters or more: what lies outside
the patterns' spans, and of that, if it is no span either, what lies between
``=`` and ``/``. A part is a span if it is suspicious by itself; a word that says
so suppresses only the part it is in.

A text takes time in proportion to its length and, up to a small factor, the number of
its matches: matches and candidates are merged in one sweep by start, a candidate's
pieces are cut from its own bytes, and what is found is gathered in blocks.

Null texts are empty and have no span. Repeated rows are scanned alike. An empty
table gives no rows. Further columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregate.llm.common import bound, folded

# The patterns of the contract, the letters of the first in either case.
ASSIGN = (
    "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 24
CANDIDATE = "[A-Za-z0-9+/_=-]{24,}"
# Of a candidate, next to = or /; a run of these signs is tried from its start only.
PART = "(?<=[=/])[A-Za-z0-9+_-]{24,}|(?<![A-Za-z0-9+_-])[A-Za-z0-9+_-]{24,}+(?=[=/])"
# Bits per character that a class's window has to reach.
THRESHOLDS = {"hex": 3.1, "alnum": 3.7, "base64": 3.7}
# What is let through.
SHAPES = (
    "^[^0-9]*$|^[0-9_=+/-]+$|^[A-Za-z]+(?:[+/_=-]+(?:[A-Za-z]+|[0-9]{1,4}))*[+/_=-]*$"
    "|^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
)
SAYS_SO = (
    "(?:[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Dd][Uu][Mm][Mm][Yy]|[Xx]{4,})"
)
ALLOWED = SHAPES + "|" + SAYS_SO

# As Java runs it: a group repeated without a way back needs no stack for each repeat; the same texts match.
JVM_SHAPES = SHAPES.replace("{1,4}))*[", "{1,4}))*+[")

SPAN = "struct<start:int,kind:int,finish:int>"
MATCH = "struct<start:int,text:string,finish:int>"
PIECE = "struct<start:int,kind:int,finish:int,text:string>"  # kind 1: a part

# The counts of a window are a text of one letter per kind of character, A for none.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"  # a window of 24 has counts up to 24
RISE = [(n + 1) * math.log2(n + 1) - (n * math.log2(n) if n else 0.0) for n in range(WINDOW + 1)]  # of n * log2(n)


def located(value: Column, pattern: str) -> Column:
    """All matches of a pattern: ``start`` (from 0), ``text``, ``finish``."""

    def placed(found: Column) -> Column:
        between = F.slice(F.split(value, pattern, -1), 1, F.size(found))
        pairs = F.zip_with(between, found, lambda gap, hit: F.struct(
            F.char_length(gap).alias("gap"), F.char_length(hit).alias("length"), hit.alias("hit")
        ))

        def step(at: Column, x: Column) -> tuple[Column, Column]:
            start = at + x["gap"]
            made = F.struct(start.alias("start"), x["hit"].alias("text"), (start + x["length"]).alias("finish"))
            return start + x["length"], F.array(made)

        return folded(pairs, F.lit(0), MATCH, step)["out"]

    none = F.array().cast(f"array<{MATCH}>")
    return F.when(value.rlike(pattern), bound(F.regexp_extract_all(value, F.lit(pattern), F.lit(0)), placed)).otherwise(none)


def spans(value: Column, pattern: str, kind: int, holds: Column | None = None) -> Column:
    """Spans of one pattern; ``holds`` is an array of booleans that keeps some of the matches."""

    def span(x: Column) -> Column:
        return F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["finish"].alias("finish"))

    found = located(value, pattern)
    if holds is not None:
        both = F.zip_with(found, holds, lambda x, ok: F.struct(x.alias("x"), ok.alias("ok")))
        return F.transform(F.filter(both, lambda b: b["ok"] & b["x"].isNotNull()), lambda b: span(b["x"]))
    return F.transform(found, span)


def peak_entropy(candidate: Column) -> Column:
    """The highest Shannon entropy, in bits per character, of any window of the candidate.

    The state holds the counts of the characters in the window, as a text of one
    letter each, and the sum of n * log2(n); a character's coming and going changes
    one letter and one term each.
    """
    rises = F.array(*[F.lit(r) for r in RISE])

    def count(counts: Column, place: Column) -> Column:
        return F.ascii(F.substr(counts, place, F.lit(1))) - ord(LETTERS[0])

    def with_count(counts: Column, place: Column, n: Column) -> Column:
        return F.overlay(counts, F.substr(F.lit(LETTERS), n + 1, F.lit(1)), place, F.lit(1))

    def slide(codes: Column) -> Column:
        begin = F.struct(F.repeat(F.lit(LETTERS[0]), F.array_max(codes)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(-1.0).alias("least"), F.lit(0).alias("at"))

        def step(state: Column, enters: Column) -> Column:
            def left(old: Column) -> Column:
                fewer = F.when(full_before, with_count(state["counts"], leaves, old - 1)).otherwise(state["counts"])
                total = state["sum"] - F.when(full_before, F.get(rises, old - 1)).otherwise(0.0)
                return F.struct(fewer.alias("counts"), total.alias("sum"))

            def entered(s: Column) -> Column:
                return bound(count(s["counts"], enters), lambda n: F.struct(
                    with_count(s["counts"], enters, n + 1).alias("counts"), (s["sum"] + F.get(rises, n)).alias("sum")
                ))

            def judged(s: Column) -> Column:
                full = state["at"] >= WINDOW - 1
                lower = full & ((state["least"] < 0) | (s["sum"] < state["least"]))
                least = F.when(lower, s["sum"]).otherwise(state["least"])
                return F.struct(s["counts"].alias("counts"), s["sum"].alias("sum"), least.alias("least"), (state["at"] + 1).alias("at"))

            full_before = state["at"] >= WINDOW
            leaves = F.get(codes, state["at"] - WINDOW)
            old = F.when(full_before, count(state["counts"], leaves)).otherwise(0)
            return bound(bound(bound(old, left), entered), judged)

        return F.aggregate(codes, begin, step, lambda state: state["least"])

    def places(characters: Column) -> Column:
        return bound(F.array_distinct(characters), lambda kinds: F.transform(characters, lambda c: F.array_position(kinds, c).cast("int")))

    codes = bound(F.split(candidate, ""), places)
    return F.lit(math.log2(WINDOW)) - bound(codes, slide) / F.lit(float(WINDOW))


def suspicious(candidate: Column) -> Column:
    """Not on the allow-list, and a window of its class's entropy."""
    needed = (
        F.when(candidate.rlike("^[0-9a-fA-F]+$"), F.lit(THRESHOLDS["hex"]))
        .when(candidate.rlike("^[A-Za-z0-9]+$"), F.lit(THRESHOLDS["alnum"]))
        .otherwise(F.lit(THRESHOLDS["base64"]))
    )
    allowed = candidate.rlike(JVM_SHAPES) | candidate.rlike(SAYS_SO)
    return F.when(allowed, F.lit(False)).otherwise(peak_entropy(candidate) >= needed)


def joined(found: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.array_sort(found),
            lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["finish"].cast("string")),
        ),
        ",",
    )


def pieces_outside(base: Column, runs: Column, kind: int) -> Column:
    """What of each run lies outside the patterns' spans, in pieces of 24 characters or more; a run that meets none is one.

    Spans and runs are swept by start.
    """
    item = "struct<start:int,kind:int,finish:int,bytes:binary>"
    no_bytes = F.lit(None).cast("binary")
    spans_in = F.transform(base, lambda b: F.struct(b["start"], F.lit(0), b["finish"], no_bytes)).cast(f"array<{item}>")
    runs_in = F.transform(
        runs, lambda r: F.struct(r["start"], F.lit(1), r["finish"], r["text"].cast("binary"))  # cut at once, whatever the place
    ).cast(f"array<{item}>")
    end = F.lit((1 << 31) - 1)
    last = F.array(F.struct(end, F.lit(1), end, no_bytes)).cast(f"array<{item}>")
    none = F.array().cast(f"array<{PIECE}>")

    def piece(s: Column, finish: Column) -> Column:
        text = F.substr(s["bytes"], s["at"] - s["start"] + 1, finish - s["at"]).cast("string")
        made = F.struct(s["at"].alias("start"), F.lit(kind).alias("kind"), finish.alias("finish"), text.alias("text"))
        return F.when(s["bytes"].isNotNull() & (finish - s["at"] >= WINDOW), F.array(made)).otherwise(none)

    def state(start: Column, finish: Column, bytes_: Column, at: Column, reach: Column) -> Column:
        return F.struct(
            start.alias("start"), finish.alias("finish"), bytes_.alias("bytes"), at.alias("at"), reach.alias("reach")
        )

    def step(s: Column, x: Column) -> tuple[Column, Column]:
        span = x["kind"] == 0
        reach = F.greatest(s["reach"], F.when(span, x["finish"]).otherwise(0))
        inside = state(s["start"], s["finish"], s["bytes"], F.greatest(s["at"], x["finish"]), reach)
        opened = state(x["start"], x["finish"], x["bytes"], F.greatest(x["start"], s["reach"]), reach)
        ends = F.when(span, F.least(x["start"], s["finish"])).otherwise(s["finish"])
        return F.when(span, inside).otherwise(opened), piece(s, ends)

    begin = state(F.lit(0), F.lit(0), no_bytes, F.lit(0), F.lit(0))
    swept = F.concat(F.sort_array(F.concat(spans_in, runs_in)), last)
    return F.when(F.size(runs) > 0, folded(swept, begin, PIECE, step)["out"]).otherwise(none)


def chosen(marked: Column) -> Column:
    """Of pieces and their parts the spans: a piece that is ``ok``, else those of its parts that are."""
    none = F.array().cast(f"array<{SPAN}>")

    def step(piece: Column, x: Column) -> tuple[Column, Column]:
        part = x["kind"] == 1
        holds = x["ok"] & (~part | ((x["start"] < piece["finish"]) & ~piece["ok"]))
        span = F.struct(x["start"].alias("start"), F.lit(3).alias("kind"), x["finish"].alias("finish"))
        after = F.struct(x["finish"].alias("finish"), x["ok"].alias("ok"))
        return F.when(part, piece).otherwise(after), F.when(holds, F.array(span)).otherwise(none)

    begin = F.struct(F.lit(0).alias("finish"), F.lit(False).alias("ok"))
    return F.when(F.size(marked) > 0, folded(F.sort_array(marked), begin, SPAN, step)["out"]).otherwise(none)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its id, ``base`` and ``added``: arrays of spans (start, kind as in ``KINDS``, finish)."""
    value = F.col("value")
    long_enough = F.transform(
        F.regexp_extract_all(value, F.lit(ASSIGN), F.lit(1)), lambda secret: F.char_length(secret) >= ASSIGN_LEAST
    )
    base = F.concat(spans(value, ASSIGN, 0, long_enough), spans(value, ACCESS, 1), spans(value, HEX, 2))
    unshaped = F.filter(located(value, CANDIDATE), lambda r: ~r["text"].rlike(JVM_SHAPES))
    judged = F.transform(
        F.concat(pieces_outside(F.col("base"), F.col("runs"), 0), pieces_outside(F.col("base"), F.col("parts"), 1)),
        lambda x: F.struct(
            x["start"].alias("start"), x["kind"].alias("kind"), x["finish"].alias("finish"), suspicious(x["text"]).alias("ok")
        ),
    )
    # one step at a time: each is planned by itself
    return (
        docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("value"))
        .select("id", base.alias("base"), unshaped.alias("runs"), located(value, PART).alias("parts"))
        .select("id", "base", judged.alias("judged"))
        .select("id", "base", chosen(F.col("judged")).alias("added"))
    )
