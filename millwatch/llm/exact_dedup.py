"""Exact dedup by a content sort.

Splitters sampled over (first characters, digest, id) range-partition the normalised
texts, each partition is sorted externally, and neighbours are compared in full. A group
of any size may span partitions: the id is part of the order, so a group that holds a
third of all rows is cut into ranges like any other rows. Only the first and last run of
each partition can continue elsewhere; these (two rows a partition) are merged by digest.
The order uses a bounded prefix and the digest of the whole text in place of the rest, so
that splitters stay small however long the texts are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwatch.llm.common import SPACES, arrow_map, quoted, same_columns, unused, whole_text, written

PREFIX_CHARS = 64
_SPACES = re.compile(SPACES.encode())
_NORM, _SHA, _PREFIX, _ID = "_mw_norm", "_mw_sha", "_mw_prefix", "_mw_id"


def normalised(text_col: str = "text"):
    """Every run of white space as one space; null counts as empty."""
    return F.regexp_replace(whole_text(text_col), SPACES, " ")


def content_sorted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows in content order over all partitions; smallest id first, null ids last."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias(_ID),
        normalised(text_col).alias(_NORM),
    )
    rows = rows.withColumn(_PREFIX, F.left(_NORM, F.lit(PREFIX_CHARS))).withColumn(
        _SHA, F.sha2(F.col(_NORM).cast("binary"), 256)
    )
    order = [F.asc(_PREFIX), F.asc(_SHA), F.asc_nulls_last(_ID)]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(
        F.asc(_PREFIX), F.asc(_SHA), F.asc(_NORM), F.asc_nulls_last(_ID)
    )
    return placed.drop(_PREFIX)


def _run_starts(batch: pa.RecordBatch, last: pa.Scalar | None) -> list[bool]:
    """Whether each row differs from the row before it, comparing whole texts."""
    texts = batch.column(_NORM)
    first = last is None or not texts[0].equals(last)
    same = pc.equal(texts.slice(1), texts.slice(0, len(texts) - 1))
    return [first, *(not x for x in same.to_pylist())]


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document; a run's rows are held as bare ids until its size is known."""
    part = TaskContext.get().partitionId()
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("text_sha256", pa.string()), ("part", pa.int32()),
            ("keep_id", pa.int64()), ("group_size", pa.int64()), ("head", pa.bool_()), ("edge", pa.bool_()),
        ]
    )
    ids: list[int | None] = []
    sha, last, runs = None, None, 0
    out: dict[str, list] = {name: [] for name in schema.names}

    def close(final: bool) -> None:
        n = len(ids)
        out["doc_id"] += ids
        out["text_sha256"] += [sha] * n
        out["part"] += [part] * n
        out["keep_id"] += [ids[0]] * n
        out["group_size"] += [n] * n
        out["head"] += [True] + [False] * (n - 1)
        out["edge"] += [runs == 1 or final] * n

    for batch in batches:
        if not batch.num_rows:
            continue
        row_ids, row_sha = batch.column(_ID).to_pylist(), batch.column(_SHA).to_pylist()
        for i, starts in enumerate(_run_starts(batch, last)):
            if starts:
                if ids:
                    close(final=False)
                ids, sha, runs = [], row_sha[i], runs + 1
            ids.append(row_ids[i])
        last = batch.column(_NORM)[batch.num_rows - 1]
        if len(out["doc_id"]) >= 10_000:
            yield pa.RecordBatch.from_pydict(out, schema)
            out = {name: [] for name in schema.names}
    if ids:
        close(final=True)
        yield pa.RecordBatch.from_pydict(out, schema)


def _spanning(heads: DataFrame) -> DataFrame:
    """Groups that reach over partitions, from the edge runs (at most two rows a partition)."""
    return heads.groupBy("text_sha256").agg(
        F.min("part").alias("_first"),
        F.min_by("keep_id", "part").alias("_keep"),
        F.sum("group_size").alias("_size"),
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256.

    Null text is empty text, and all empty texts form one group (of blanks, one space is
    another text). Of equal texts the smallest id is kept, null ids come last; of rows
    that repeat id and text one is kept. An empty table gives no rows; other columns are
    not read.
    """
    runs = arrow_map(
        content_sorted(docs, id_col, text_col),
        _decide,
        "doc_id bigint, text_sha256 string, part int, keep_id bigint, group_size bigint, "
        "head boolean, edge boolean",
    )
    runs = written(runs, "content-runs")
    edges = _spanning(runs.filter("head AND edge"))
    return runs.join(F.broadcast(edges), "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("_first").isNull(), F.col("keep_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_size", "group_size").alias("group_size"),
        (F.col("head") & (F.coalesce("_first", "part") == F.col("part"))).alias("kept"),
        "text_sha256",
    )


def _heads(width: int, text_at: int, names: list[str]):
    """``width`` columns of documents and the digest come in; a run's place is added.

    Neighbours of equal digests are compared in full, normalised here, so that no task holds a
    text twice.
    """

    def plain(text: pa.Scalar) -> bytes:
        # As bytes, since a text that is carried along need not be valid UTF-8.
        return _SPACES.sub(b" ", text.cast(pa.binary()).as_py() or b"")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first row of each run, with the run's place in the partition."""
        part, runs = TaskContext.get().partitionId(), 0
        last_sha, last_text, last_plain = None, None, None
        held = None  # the newest head: whether it is the last run shows only at the end

        def labelled(rows: pa.RecordBatch, first_run: bool, final: bool) -> pa.RecordBatch:
            edge = [False] * rows.num_rows
            if first_run:
                edge[0] = True
            if final:
                edge[-1] = True
            added = [pa.array([part] * rows.num_rows, pa.int32()), pa.array(edge)]
            return pa.RecordBatch.from_arrays([*rows.columns, *added], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            starts, texts = [], batch.column(text_at)
            for sha, text in zip(batch.column(width).to_pylist(), texts, strict=True):
                same = sha == last_sha
                if same:
                    if last_plain is None:
                        last_plain = plain(last_text)
                    same = plain(text) == last_plain
                if not same:
                    last_plain = None
                last_sha, last_text = sha, text
                starts.append(not same)
            rows = batch.filter(pa.array(starts))
            if not rows.num_rows:
                continue
            if held is not None:
                yield labelled(held, runs == 1, final=False)
            if rows.num_rows > 1:
                yield labelled(rows.slice(0, rows.num_rows - 1), runs == 0, final=False)
            runs += rows.num_rows
            held = rows.slice(rows.num_rows - 1)
        if held is not None:
            yield labelled(held, runs == 1, final=True)

    return work


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each text, all columns kept; same rules as ``exact_groups``.

    Columns may have any name. Texts that are not UTF-8 are equal if their bytes are, white space aside.
    """
    norm, sha, prefix, key, part, edge, first = (
        unused(docs, f"_mw_{name}") for name in ("norm", "sha", "prefix", "id", "part", "edge", "first")
    )
    kept = [F.col(quoted(c)) for c in docs.columns]
    rows = docs.select(
        *kept, F.col(quoted(id_col)).cast("bigint").alias(key),
        normalised(quoted(text_col)).alias(norm),
    )
    rows = rows.withColumn(prefix, F.left(norm, F.lit(PREFIX_CHARS))).withColumn(
        sha, F.sha2(F.col(norm).cast("binary"), 256)
    )
    order = [F.asc(prefix), F.asc(sha), F.asc_nulls_last(key)]
    placed = rows.drop(norm).repartitionByRange(*order).sortWithinPartitions(*order)
    added = [T.StructField(sha, T.StringType()), T.StructField(part, T.IntegerType()), T.StructField(edge, T.BooleanType())]
    schema = T.StructType([*docs.schema.fields, *added])
    work = _heads(len(docs.columns), docs.columns.index(text_col), schema.names)
    # Names of its own, since a batch map cannot look up columns with a dot in their name.
    sent = placed.select(*kept, sha).toDF(*[f"c{k}" for k in range(len(docs.columns) + 1)])
    heads = written(arrow_map(sent, work, schema), "content-heads")
    spanning = heads.filter(F.col(edge)).groupBy(sha).agg(F.min(part).alias(first))
    alone = heads.join(F.broadcast(spanning), sha, "left").filter(F.coalesce(first, part) == F.col(part))
    return same_columns(alone, docs)
