"""Document fingerprints: a Merkle tree over paragraphs and sections.

A text's lines are its paragraphs, eight paragraphs in a row a section. A
paragraph's node is the SHA-256 of its text, a section's of its paragraphs'
nodes, the root's of its sections' nodes; each level hashes with a mark of its
own. Equal roots mean equal texts. Where roots differ, comparing sections and
then only the paragraphs of sections that differ locates the edits
(``edited_paragraphs``). Below the paragraphs are the leaves, pieces of at most
64 characters of a line, by which two texts are likened: twice the number of
distinct leaves they share over the sum of those they have. Leaves are cut at a
fixed stride from the start of each line: a text of one line below 96 characters
keeps none when its last third is replaced, and a character put into a long line
shifts all later leaves of it. ``fine_likeness`` knows neither loss: it likens
runs of characters wherever they lie, ``edit_probe`` uses it with ``fine=True``.

Null counts as empty; a text without a leaf is like an equal text and no other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faregate.operators.layout import written

SECTION = 8
LEAF = "[^\n]{1,64}"
GRAM = 8  # characters of a run that fine likeness compares
KEPT = 256  # about as many runs, to twice as many, of a text are compared


def paragraphs(value: Column) -> Column:
    return F.transform(F.split(value, "\n", -1), lambda line: F.sha2(F.concat(F.lit("paragraph:"), line), 256))


def sections(nodes: Column) -> Column:
    starts = F.sequence(F.lit(1), F.size(nodes), F.lit(SECTION))
    return F.transform(
        starts, lambda at: F.sha2(F.concat(F.lit("section:"), F.array_join(F.slice(nodes, at, SECTION), "")), 256)
    )


def root(nodes: Column) -> Column:
    return F.sha2(F.concat(F.lit("root:"), F.array_join(nodes, "")), 256)


def fingerprint(value: Column) -> Column:
    return root(sections(paragraphs(value)))


def leaves(value: Column) -> Column:
    return F.array_distinct(
        F.transform(F.regexp_extract_all(value, F.lit(LEAF), F.lit(0)), lambda piece: F.xxhash64(piece))
    )


def likeness(a: Column, b: Column, same: Column) -> Column:
    total = F.size(a) + F.size(b)
    shared = F.size(F.array_intersect(a, b))
    return F.when(same, F.lit(1.0)).when(total == 0, F.lit(0.0)).otherwise(2.0 * shared / total)


def _bound(value: Column, make) -> Column:
    """``make(value)`` with the value computed once, not again for each element that a function inside looks at."""
    return F.get(F.transform(F.array(value), make), 0)


def grams(value: Column) -> Column:
    """``rate`` and ``hashes`` of distinct runs of ``GRAM`` characters; of a long text one in ``rate``, picked by content.

    A run ends at each character; those of the first ones begin before the text.
    """
    n = F.char_length(value)
    padded = F.split(F.concat(F.lit("\0" * (GRAM - 1)), value), "")

    def runs(chars: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(chars, i + k) for k in range(GRAM)]),
        )

    doublings = F.floor(F.log2(F.greatest(n / KEPT, F.lit(1.0)))).cast("int")
    rate = F.pow(F.lit(2.0), doublings).cast("bigint")
    picked = F.struct(rate.alias("rate"), _bound(padded, runs).alias("every"))
    found = _bound(picked, lambda x: F.array_distinct(F.filter(x["every"], lambda h: F.pmod(h, x["rate"]) == 0)))
    return F.struct(
        rate.alias("rate"), F.when(n > 0, found).otherwise(F.array().cast("array<bigint>")).alias("hashes")
    )


def fine_likeness(a: Column, b: Column, same: Column) -> Column:
    """Likeness of two ``grams``, both thinned to the coarser rate."""

    def of(pair: Column) -> Column:
        rate = F.greatest(pair["a"]["rate"], pair["b"]["rate"])
        one, two = (F.filter(pair[k]["hashes"], lambda h: F.pmod(h, rate) == 0) for k in "ab")
        return likeness(one, two, pair["same"])

    return _bound(F.struct(a.alias("a"), b.alias("b"), same.alias("same")), of)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` as ``row``, with ``fingerprint``, ``sections``, ``paragraphs`` and ``leaves``."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return (
        docs.select(row, paragraphs(value).alias("paragraphs"), leaves(value).alias("leaves"))
        .withColumn("sections", sections(F.col("paragraphs")))
        .withColumn("fingerprint", root(F.col("sections")))
    )


def edited_paragraphs(a_sections: Column, a_nodes: Column, b_sections: Column, b_nodes: Column) -> Column:
    """Places (from 0) of paragraphs that differ, found by going down only where sections differ."""
    last = F.greatest(F.size(a_sections), F.size(b_sections)) - 1
    unlike = F.filter(
        F.sequence(F.lit(0), last), lambda i: ~F.get(a_sections, i).eqNullSafe(F.get(b_sections, i))
    )
    below = F.flatten(F.transform(unlike, lambda i: F.sequence(i * SECTION, i * SECTION + SECTION - 1)))
    return F.filter(below, lambda i: ~F.get(a_nodes, i).eqNullSafe(F.get(b_nodes, i)))


def following(docs: DataFrame, doc_id: str, chars: Column) -> DataFrame:
    """``id, chars, next_id`` of each distinct id in descending order; the last is followed by the first.

    Ids are range-partitioned and written; only the first id of each partition
    meets the others in one place. A null id comes last. ``chars`` is the longest
    of the rows that share an id.
    """
    ids = written(docs.groupBy(F.col(f"`{doc_id}`").alias("id")).agg(F.max(chars).alias("chars")))
    down = F.col("id").desc_nulls_last()
    ordered = written(
        ids.repartitionByRange(down).sortWithinPartitions(down).withColumn("part", F.spark_partition_id())
    )
    head = F.max(F.struct(F.col("id").isNotNull().alias("known"), "id"))
    heads = ordered.groupBy("part").agg(head.alias("head"))
    by_part = Window.orderBy("part")  # a row per partition
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(
        "part", F.coalesce(F.lead("head").over(by_part), F.first("head").over(whole)).alias("next_head")
    )
    own = F.struct(F.col("id").isNotNull().alias("known"), "id")
    inside = Window.partitionBy("part").orderBy(down)
    return (
        ordered.withColumn("inner_next", F.lead(own).over(inside))
        .join(heads, "part")
        .select("id", "chars", F.coalesce("inner_next", "next_head")["id"].alias("next_id"))
    )


def edit_probe(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fine: bool = False) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and its neighbour's are.

    The edited text has its last third of characters replaced by the first as
    many of the next document's (in descending order of ids). Rows that share an
    id are one document as a neighbour: the one whose text comes first.
    Texts are shuffled by id once and used twice, as themselves and as what
    follows another; what crosses a second time is at most a third of a text and
    the leaves. With ``fine``, texts are likened by ``grams`` instead of leaves.
    """
    pieces, alike = (grams, fine_likeness) if fine else (leaves, likeness)
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    source = docs.select(F.col(f"`{doc_id}`").alias("id"), value.alias("value"))
    after = following(docs, doc_id, F.char_length(value)).withColumnRenamed("id", "for_id")
    neighbour = F.struct(
        F.col("value").substr(F.lit(1), F.floor(F.col("chars") / 3).cast("int")).alias("start"),
        pieces(F.col("value")).alias("leaves"),
        fingerprint(F.col("value")).alias("root"),
    )
    neighbours = (
        source.join(after, F.col("id").eqNullSafe(F.col("next_id")))
        .select("for_id", neighbour.alias("next"))
        .groupBy("for_id")
        .agg(F.min("next").alias("next"))
    )
    n = F.col("n_chars")
    third = F.floor(n / 3).cast("int")
    joined = (
        source.join(neighbours, F.col("id").eqNullSafe(F.col("for_id")))
        .withColumn("n_chars", F.char_length("value").cast("bigint"))
        .withColumn(
            "edited",
            F.concat(
                F.col("value").substr(F.lit(1), (n - third).cast("int")), F.col("next.start").substr(F.lit(1), third)
            ),
        )
    )
    measured = joined.select(
        F.col("id").alias(doc_id),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("value")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        pieces(F.col("value")).alias("own"),
        pieces(F.col("edited")).alias("changed"),
        "next",
    )
    return measured.select(
        doc_id,
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        alike(F.col("own"), F.col("changed"), F.col("fingerprint") == F.col("edited_fingerprint")).alias("near_edited"),
        alike(F.col("own"), F.col("next.leaves"), F.col("fingerprint") == F.col("next.root")).alias("near_next"),
    )
