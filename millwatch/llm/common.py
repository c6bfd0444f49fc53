"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.session import scratch_path

# White space of all contracts: space and the ASCII controls from tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"

# Id lists up to this length (two longs a row, some 100 MB hashed) are broadcast, longer ones joined.
BROADCAST_IDS = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def once(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def valid_text(column: str = "text") -> Column:
    """The text with U+FFFD in place of bytes that are not UTF-8; null stays null."""
    return F.make_valid_utf8(F.col(quoted(column)).cast("string"))


def crc_of_id(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


# Bytes of the batches that go to Python: Spark, the worker and what it returns hold some of them each.
BATCH_BYTES = "8m"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While this lasts, batches for Python are bounded in bytes, since texts may be very long."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, BATCH_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_ids(big: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """``big`` joined to a narrow stored table of ids.

    The ids are counted first: up to ``BROADCAST_IDS`` of them are broadcast, which
    leaves ``big`` unshuffled; beyond that the join shuffles both sides on the key.
    """
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return big.join(ids, key, how)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names are told apart as Spark does, without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def same_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(quoted(c)) for c in like.columns])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in the one column of ``ids``; rows without id stay."""
    key = unused(docs, "_mw_id")
    marked = docs.withColumn(key, F.col(quoted(id_col)).cast("bigint"))
    return same_columns(join_ids(marked, ids.toDF(key), key, "left_anti"), docs)


def arrow_map(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return df.mapInArrow(work, schema)


# What this Python worker keeps from task to task.
_KEPT: dict[tuple, object] = {}


def worker_cache(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` made for this key, kept between tasks until something else is to be kept.

    A Python worker serves the tasks of many operators in turn. It holds the words of one of
    them only, so that the memory of a chain of operators is that of its largest.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal keys of a partition that is sorted by ``keys``, one table at a time."""
    pending: list[pa.Table] = []
    current: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns, strict=True))
        start = 0
        whole = pa.Table.from_batches([batch])
        while start < len(rows):
            end = start + 1
            while end < len(rows) and rows[end] == rows[start]:
                end += 1
            if current is not None and rows[start] != current:
                yield current, pa.concat_tables(pending)
                pending = []
            current = rows[start]
            pending.append(whole.slice(start, end - start))
            start = end
    if pending:
        yield current, pa.concat_tables(pending)


# Links that one task contracts: 16 bytes each as they come, some 300 bytes a node while it works.
LINKS_PER_TASK = 1_000_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars: each node with the smallest node it is connected to."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, root)
        return root

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if find(x) != x]
    for start in range(0, len(nodes), 50_000):
        some = nodes[start : start + 50_000]
        roots = [find(x) for x in some]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(roots, pa.int64())], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph: (node, component), its smallest node.

    ``edges`` has long columns ``u`` and ``v``. Tasks of up to LINKS_PER_TASK links contract
    their own links to stars, without a shuffle key, until one task's worth is left or
    nothing moves. Where that does not halve the links (components spread over many tasks),
    a round of large-star and small-star steps joins the stars of different tasks: sums per
    node are pre-aggregated, and the joins can split hot nodes. Every step is a written
    table. Nodes without a link to another node do not appear.
    """
    edges = edges.filter("u <> v").select("u", "v")
    size, state = edges.count(), None
    while True:
        parts = max(1, -(-size // LINKS_PER_TASK))
        edges = written(arrow_map(edges.repartition(parts), _forest, "u bigint, v bigint"), "links")
        if parts == 1:
            break
        before, size = size, edges.count()
        if size > before // 2:
            edges = written(_star_round(edges), "links")
            # Both halves of a hash are summed, so equal sums mean equal links: nothing moves any more.
            pair = F.xxhash64("u", "v")
            sums = edges.agg(F.count("*"), F.sum(pair.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(pair, 32)))
            before, state = state, sums.first()
            if state == before:
                break
            size = state[0]
    # Stars: each node points at the smallest of its component.
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)


def _star_round(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node, then smaller ones, move to the smallest node it knows of."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.filter("m < u").select("u", F.col("m").alias("v")))
        .distinct()
    )
    # Here every v < u.
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    return (
        large.join(lowest, "u")
        .filter("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(lowest.select("u", F.col("m").alias("v")))
        .distinct()
    )
