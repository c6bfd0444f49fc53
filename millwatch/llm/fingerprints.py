"""Document fingerprints by a homomorphic multiset hash, native expressions only.

A text is the multiset of its paragraphs (lines; a line of more than ``LINE_CHARS``
characters is cut after that many). Each paragraph hashes to a wide vector, the fingerprint is the
sum of the vectors modulo powers of two: ``DENSE`` lanes of 32 bits that every paragraph
adds to, for equality, and ``SPARSE`` lanes of 32 bits of which a paragraph counts in one,
for likeness. Only lanes in use are stored, so there are enough of them to keep different
paragraphs apart in the longest texts, and a vector grows with the distinct paragraphs.
Sums do not depend on order, and adding or subtracting a paragraph's vector inserts or
deletes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwatch.llm.common import once, whole_text, written

DENSE, DENSE_BITS = 4, 32
SPARSE, SPARSE_BITS = 1 << 24, 32
LINE_CHARS = 240
# Cells of the id range, and documents a neighbour bucket aims at.
CELLS, BUCKET_DOCS = 1 << 16, 1_000


def paragraphs(text: Column) -> Column:
    """Non-empty lines, long ones in pieces of LINE_CHARS characters; one pass over the text."""
    return F.regexp_extract_all(text, F.lit(f"[^\\n]{{1,{LINE_CHARS}}}"), F.lit(0))


def _entries(units: Column) -> Column:
    """Sums by lane of (lane, add) pairs, as lane * 2**SPARSE_BITS + sum in lane order; zero sums drop out.

    Pairs are first dealt to as many parts as the square root of their number, so that the
    work does not grow with its square.
    """
    low, zero = (1 << SPARSE_BITS) - 1, F.lit(0).cast("bigint")

    def sums(mine: Column) -> Column:
        def summed(lane: Column) -> Column:
            total = F.aggregate(
                F.filter(mine, lambda u: u["lane"] == lane), zero, lambda acc, u: (acc + u["add"]).bitwiseAND(low)
            )
            return F.shiftleft(lane, SPARSE_BITS) + total

        return F.transform(F.array_distinct(F.transform(mine, lambda u: u["lane"])), summed)

    def dealt(parts: Column) -> Column:
        one = lambda i: once(F.filter(units, lambda u: F.pmod(u["lane"], parts) == i), sums)
        return F.flatten(F.transform(F.sequence(F.lit(0), parts - 1), one))

    parts = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(units))).cast("int"))
    return F.array_sort(F.filter(once(parts, dealt), lambda e: e.bitwiseAND(low) != 0))


def _pairs(entries: Column, sign: int) -> Column:
    low = (1 << SPARSE_BITS) - 1

    def pair(e: Column) -> Column:
        add = (e.bitwiseAND(low) * sign).bitwiseAND(low)
        return F.struct(F.shiftright(e, SPARSE_BITS).alias("lane"), add.alias("add"))

    return F.transform(entries, pair)


def vector_of(text: Column) -> Column:
    """The summed lanes of a text: the dense ones, then an entry for each sparse one that is not zero."""
    mask, zero = (1 << DENSE_BITS) - 1, F.lit(0).cast("bigint")

    def dense_lane(units: Column, k: int) -> Column:
        add = lambda h: F.xxhash64(h, F.lit(k)).bitwiseAND(mask)
        return F.aggregate(units, zero, lambda acc, h: (acc + add(h)).bitwiseAND(mask))

    def pair(h: Column) -> Column:
        return F.struct(h.bitwiseAND(SPARSE - 1).alias("lane"), F.lit(1).cast("bigint").alias("add"))

    def lanes(units: Column) -> Column:
        dense = F.array(*[dense_lane(units, k) for k in range(DENSE)])
        return F.concat(dense, once(F.transform(units, pair), _entries))

    return once(F.transform(paragraphs(text), lambda p: F.xxhash64(p)), lanes)


def _dense(vector: Column) -> Column:
    return F.slice(vector, 1, DENSE)


def _sparse(vector: Column) -> Column:
    return F.slice(vector, DENSE + 1, F.size(vector) - DENSE)


def inserted(vector: Column, paragraph: Column, sign: int = 1) -> Column:
    """The vector with one paragraph more (or, with ``sign=-1``, one less)."""
    mask = (1 << DENSE_BITS) - 1

    def added(change: Column) -> Column:
        both = F.arrays_zip(_dense(vector).alias("a"), _dense(change).alias("b"))
        dense = F.transform(both, lambda p: (p["a"] + sign * p["b"]).bitwiseAND(mask))
        sparse = F.concat(_pairs(_sparse(vector), 1), _pairs(_sparse(change), sign))
        return F.concat(dense, once(sparse, _entries))

    return once(vector_of(paragraph), added)


def as_hex(vector: Column) -> Column:
    """Eight digits a dense lane, then 14 an entry: six of the lane, eight of its sum."""
    digits = F.transform(
        vector, lambda v, i: F.lower(F.lpad(F.hex(v), F.when(i < DENSE, F.lit(8)).otherwise(F.lit(14)), F.lit("0")))
    )
    return F.array_join(digits, "")


def likeness(a: Column, b: Column) -> Column:
    """Paragraphs that both have over those that either has, repeats counted; 1 for equal vectors.

    The counts of the vectors and of their difference give it; it is exact but for different
    paragraphs that share one of the SPARSE lanes.
    """
    low, half, zero = (1 << SPARSE_BITS) - 1, 1 << (SPARSE_BITS - 1), F.lit(0).cast("bigint")

    def count(entries: Column) -> Column:
        size = lambda n: F.when(n < half, n).otherwise((low + 1) - n)
        return F.aggregate(entries, zero, lambda acc, e: acc + size(e.bitwiseAND(low)))

    apart = count(once(F.concat(_pairs(_sparse(a), 1), _pairs(_sparse(b), -1)), _entries))
    share = once(
        F.struct((count(_sparse(a)) + count(_sparse(b))).alias("all"), apart.alias("apart")),
        lambda n: (n["all"] - n["apart"]) / (n["all"] + n["apart"]),
    )
    return F.when(a == b, F.lit(1.0)).otherwise(share)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, text, vector. Null counts as empty; the empty text's
    vector is zero. Equal texts have equal vectors; other columns are not read."""
    return docs.select(
        F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text")
    ).withColumn("vector", vector_of(F.col("text")))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, text, vector, next_text, next_vector): the next document by descending id,
    the first after the last.

    Null ids come last, equal ids are ordered by a digest of the text. A single row is its
    own next one. Ids are counted in equal cells of their range and neighbouring cells are
    joined to buckets of some BUCKET_DOCS documents (the cell table has at most CELLS + 1
    rows, whatever the data). Each bucket also gets a copy of the next bucket's first row,
    so no bucket needs another one.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), whole_text(text_col).alias("text"))
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    width = max(1, -(-((high or 0) - (low or 0) + 1) // CELLS))
    # Cell 0 holds the highest ids; null ids have a last cell of their own.
    down = (F.lit(high).cast("decimal(20,0)") - F.col("doc_id").cast("decimal(20,0)")) / F.lit(width)
    cell = F.when(F.col("doc_id").isNotNull(), F.floor(down).cast("int")).otherwise(F.lit(CELLS))
    rows = rows.withColumn("cell", cell)
    cells = rows.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("doc_id").alias("top_id")
    )
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = written(
        cells.select(
            "cell",
            "top_id",
            F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / BUCKET_DOCS).alias("bucket"),
        ),
        "id-cells",
    )
    # The first row of a bucket is copied to the bucket before it, that of the first to the last.
    by_bucket, everything = Window.orderBy("bucket"), Window.partitionBy()
    firsts = cells.groupBy("bucket").agg(F.max("top_id").alias("top_id"))
    firsts = firsts.select(
        F.col("bucket").alias("of"),
        F.col("top_id"),
        F.coalesce(F.lag("bucket").over(by_bucket), F.max("bucket").over(everything)).alias("to"),
    )
    placed = rows.join(F.broadcast(cells.select("cell", "bucket")), "cell").drop("cell")
    copied = placed.join(
        F.broadcast(firsts),
        (F.col("bucket") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("top_id")),
    ).select("doc_id", "text", F.col("to").alias("bucket"), F.lit(1).alias("copied"))
    both = placed.select("doc_id", "text", "bucket", F.lit(0).alias("copied")).unionByName(copied)
    # Dealt out first, so that the vectors are made behind the shuffle and not sent through it.
    dealt = both.repartition("bucket").withColumn("vector", vector_of(F.col("text")))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    order = Window.partitionBy("bucket").orderBy("copied", F.desc_nulls_last("doc_id"), digest)
    return (
        dealt.withColumn("next", F.lead(F.struct("text", "vector")).over(order))
        .filter("copied = 0")
        .select(
            "doc_id", "text", "vector",
            F.col("next.text").alias("next_text"), F.col("next.vector").alias("next_vector"),
        )
    )


def edited(text: Column, following: Column) -> Column:
    """The last half (rounded down) of the code points replaced by as many first ones of the next text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.left(text, F.length(text) - half), F.left(following, half))
