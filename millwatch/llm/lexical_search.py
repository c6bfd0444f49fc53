"""Ranked lexical search: one automaton of all item terms is run over every document.

There is no index of the documents. The terms of all items are a bounded broadcast (items are
cut into blocks of BLOCK_CHARS characters of terms, each block is one pass over the documents)
and become an Aho-Corasick automaton in each task. Every term is guarded by a blank on either
side, and so is every run of term characters of a text, so a match is a whole term. The first
pass counts term frequencies straight from the texts, and per task the documents that hold a
term; the second one scores these counts, where the automaton's outputs map to items, and
keeps the best of each task. Only tasks' bests are shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwatch.llm.common import arrow_map, whole_text, written

# Characters of the terms of one block of items: some 100 MB as an automaton.
BLOCK_CHARS = 2_000_000
# Additions that a task scores at once.
ADDITIONS = 2_000_000
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BLANKS = bytes(set(range(128)) - set(b"0123456789" + UPPER.encode() + LOWER.encode()))
# UTF-8 bytes of characters beyond ASCII stay, so a text need not be decoded.
_GUARDED = bytes.maketrans(UPPER.encode() + _BLANKS, LOWER.encode() + b" " * len(_BLANKS))


def automaton_of(terms: list[str]) -> ahocorasick.Automaton:
    """Finds terms, each with its position in the list, in texts whose terms are set between blanks."""
    found = ahocorasick.Automaton()
    for k, term in enumerate(terms):
        found.add_word(f" {term.encode('utf-8').decode('latin-1')} ", k)
    found.make_automaton()
    return found


def count_terms(text: bytes, automaton: ahocorasick.Automaton) -> tuple[int, Counter]:
    """All terms of a text with repeats, and how often each known one occurs."""
    plain = text.translate(_GUARDED)
    known = Counter(k for _, k in automaton.iter(f" {plain.decode('latin-1')} "))
    return len(plain.split()), known


_COUNTS = pa.schema(
    [("stats", pa.bool_()), ("doc_id", pa.int64()), ("n", pa.int64()), ("docs", pa.int64()),
     ("ids", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))]
)
_COUNTS_DDL = "stats boolean, doc_id bigint, n bigint, docs bigint, ids array<int>, tfs array<bigint>"


def _scan(terms: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(terms)
        df, docs, total = Counter(), 0, 0
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n, known = count_terms(text.as_py() or b"", automaton)
                docs, total = docs + (n > 0), total + n
                if known:
                    df.update(known.keys())
                    rows.append((False, doc_id, n, None, list(known), list(known.values())))
            yield _batch(rows)
        yield _batch([(True, None, total, docs, list(df), list(df.values()))])

    return work


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_COUNTS)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _COUNTS, strict=True)], schema=_COUNTS)


class _Best:
    """The best rows of each item so far."""

    def __init__(self, items: int, top: int):
        self.top = top
        # What a score must reach to be of interest.
        self.bar = np.ones(items, dtype=np.int64)
        self.item = np.empty(0, dtype=np.int64)
        self.score = np.empty(0, dtype=np.int64)
        self.doc = np.empty(0, dtype=np.int64)
        self.unnamed = np.empty(0, dtype=bool)

    def offer(self, scores: np.ndarray, docs: np.ndarray, unnamed: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.bar)
        if not len(row):
            return
        item = np.append(self.item, item)
        score = np.append(self.score, scores[row, item[len(self.item) :]])
        doc, missing = np.append(self.doc, docs[row]), np.append(self.unnamed, unnamed[row])
        order = np.lexsort((doc, missing, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[place < self.top]
        last = order[place == self.top - 1]
        self.bar[item[place == self.top - 1]] = score[last]
        self.item, self.score, self.doc, self.unnamed = item[place < self.top], score[kept], doc[kept], missing[kept]


def _rank(weights: np.ndarray, starts: np.ndarray, items: np.ndarray, names: list, docs_all: int, terms_all: int, top: int):
    """``items[starts[t]:starts[t + 1]]`` are the items of term ``t``."""
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    per_term = np.diff(starts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(names), top)
        for batch in batches:
            sizes = [90 * n * docs_all // terms_all + 10 for n in batch.column("n").to_pylist()]
            sizes = np.array(sizes, dtype=np.int64)
            ids, tfs, lists = (batch.column(c) for c in ("ids", "tfs", "ids"))
            ends = np.asarray(lists.offsets)[1:] - lists.offsets[0].as_py()
            ids, tfs = np.asarray(ids.flatten()), np.asarray(tfs.flatten())
            row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            gain = weights[ids] * ((1_000_000_000 * tfs) // (1_000 * tfs + 8 * sizes[row]))
            doc = batch.column("doc_id")
            unnamed = np.asarray(doc.is_null())
            doc = np.asarray(doc.fill_null(0))
            # Some documents at a time, so that neither their additions nor their scores grow.
            cost = np.cumsum(np.append(0, per_term[ids]))[ends] + np.arange(1, len(ends) + 1) * len(names)
            first = 0
            while first < len(ends):
                spent = cost[first - 1] if first else 0
                upto = max(first + 1, int(np.searchsorted(cost, spent + ADDITIONS, side="right")))
                part = slice(ends[first - 1] if first else 0, ends[upto - 1])
                t = ids[part]
                copies = per_term[t]
                place = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                item = items[np.repeat(starts[t], copies) + place]
                scores = np.zeros((upto - first, len(names)), dtype=np.int64)
                np.add.at(scores.reshape(-1), np.repeat(row[part] - first, copies) * len(names) + item, np.repeat(gain[part], copies))
                best.offer(scores, doc[first:upto], unnamed[first:upto])
                first = upto
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[k] for k in best.item], pa.int64()), pa.array(best.doc, mask=best.unnamed), pa.array(best.score)],
            schema=schema,
        )

    return work


def terms_of(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, term), each term once an item."""
    lowered = F.translate(whole_text(f"`{text_col}`"), UPPER, LOWER)
    terms = F.explode(F.array_distinct(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))))
    return items.select(F.col(f"`{item_col}`").cast("bigint").alias("item_id"), terms.alias("term")).distinct()


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = 10,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank, doc_id, score.

    Terms are maximal runs of letters, digits and characters beyond ASCII, with A-Z lower-cased;
    statistics and frequencies come from all whole texts. Null, empty and termless texts hold
    nothing and do not count as documents. Ties go to the smaller id, rows without id come last
    among equals. Rows that repeat an id are documents of their own; rows that repeat an item id
    are one item, as are rows without one. An item without terms, or of terms that no document
    holds, has no row; so have empty tables. Other columns are not read. Texts need not be valid
    UTF-8. The terms of one item must fit into a task.
    """
    narrow = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"),
    )
    terms = written(terms_of(items, item_col, item_text_col), "search-terms")
    chars = terms.agg(F.sum(F.length("term") + 2)).first()[0] or 0
    blocks = -(-chars // block_chars)
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))
    spark = docs.sparkSession
    found = spark.createDataFrame([], "item_id bigint, doc_id bigint, score bigint")
    for b in range(blocks):
        pairs = terms.filter(block == b).collect()  # bounded by the characters of a block
        if pairs:
            found = found.unionByName(_block_bests(narrow, pairs, top))
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _block_bests(docs: DataFrame, terms: list[tuple], top: int) -> DataFrame:
    """Scores of the best documents of each task for one block of (item, term)."""
    by_term: dict[str, list] = {}
    for item, term in terms:
        by_term.setdefault(term, []).append(item)
    words = sorted(by_term)
    names = sorted({i for of in by_term.values() for i in of}, key=lambda i: (i is None, i))
    number = {name: k for k, name in enumerate(names)}
    counts = written(arrow_map(docs, _scan(words), _COUNTS_DDL), "search-counts")
    stats = counts.filter("stats")
    docs_all, terms_all = stats.agg(F.sum("docs"), F.sum("n")).first()
    pairs = stats.select(F.explode(F.arrays_zip("ids", "tfs")).alias("p")).groupBy("p.ids").agg(F.sum("p.tfs"))
    df = np.zeros(len(words), dtype=np.int64)
    for k, n in pairs.collect():  # one row a term of the block, at most
        df[k] = n
    weights = [math.floor(1000 * math.log((2 * (docs_all or 0) + 2) / (2 * int(n) + 1))) for n in df]
    starts = np.cumsum([0, *(len(by_term[w]) for w in words)])
    of_terms = np.array([number[i] for w in words for i in by_term[w]], dtype=np.int64)
    rank = _rank(np.array(weights, dtype=np.int64), starts, of_terms, names, docs_all or 0, terms_all or 1, top)
    return arrow_map(counts.filter("NOT stats").select("doc_id", "n", "ids", "tfs"), rank, "item_id bigint, doc_id bigint, score bigint")
