"""Language-model scores: marginal probability over all subword segmentations.

The model is a unigram model over the pieces of an existing vocabulary. A piece's
probability comes from how often it occurs in the training words (as that vocabulary's
own tokenizer cuts them), smoothed; a forward recursion in log space sums over every
segmentation of a word. Pieces do not cross words, so a text's probability is the product
of its words' and of the end token's. Word counts of the whole corpus give a plain
unigram score beside it.

Documents are dealt into blocks of some BLOCK_DOCS. A block sends each distinct word once,
with its training count, and gets the word's corpus count and lattice score back: a
frequent word costs one row a block, and no task holds a corpus-wide word list. Only the
piece counts, bounded by the vocabulary, pass through the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import arrow_map, crc_of_id, sorted_groups, valid_text, written

BLOCK_DOCS = 8192
# Bytes of a block, in expectation; a task gathers some blocks, however large the table is.
BLOCK_BYTES = 24_000_000
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
WORD_SMOOTHING = 0.1
PIECE_SMOOTHING = 0.5
MARK = "▁"  # opens the first piece of a word


@lru_cache(maxsize=2)
def processor(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


class Lattice:
    """Forward recursion over the pieces of a vocabulary with given log probabilities."""

    def __init__(self, path: str, log_p: np.ndarray):
        model = processor(path)
        self.bytes = [0.0] * 256
        # Every piece and every beginning of one, so that a scan stops where no piece goes on.
        self.pieces: dict[str, float | None] = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = float(log_p[i])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[piece] = float(log_p[i])
        for piece in list(self.pieces):
            for n in range(1, len(piece)):
                self.pieces.setdefault(piece[:n], None)

    def log_prob(self, word: str) -> float:
        """Natural log of the summed probability of all segmentations of a word.

        A character that is no piece counts as its UTF-8 bytes, so every word has one.
        """
        text = MARK + word
        n = len(text)
        forward = [-math.inf] * (n + 1)
        forward[0] = 0.0
        pieces, log1p, exp = self.pieces, math.log1p, math.exp
        for i in range(n):
            base = forward[i]
            for j in range(i + 1, n + 1):
                p = pieces.get(text[i:j], 1.0)
                if p == 1.0:  # no piece begins like this
                    break
                if p is None:
                    continue
                total, seen = base + p, forward[j]
                forward[j] = max(total, seen) + log1p(exp(-abs(total - seen))) if seen > -math.inf else total
            if pieces.get(text[i]) is None:
                total, seen = base + sum(self.bytes[b] for b in text[i].encode("utf-8", "surrogatepass")), forward[i + 1]
                forward[i + 1] = max(total, seen) + log1p(exp(-abs(total - seen))) if seen > -math.inf else total
        return forward[n]


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's distinct words with their counts in its training documents."""
    for (block,), rows in sorted_groups(batches, ["block"]):
        counts: Counter[bytes] = Counter()
        for text, train in zip(rows["text"], rows["train"], strict=True):
            words = text.as_py().lower().split()
            if train.as_py():
                counts.update(words)
            else:
                for w in words:
                    counts.setdefault(w, 0)
        words, values = list(counts), list(counts.values())
        for start in range(0, len(words), 50_000):
            some = words[start : start + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(some), pa.int32()), pa.array(some, pa.binary()),
                 pa.array(values[start : start + 50_000], pa.int64())],
                ["block", "word", "c"],
            )


def piece_counts(words: DataFrame, vocabulary: str) -> np.ndarray:
    """How often each piece occurs in the counted words; one row a piece reaches the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = processor(vocabulary)
        total = np.zeros(model.get_piece_size(), dtype=np.int64)
        for batch in batches:
            texts = [w.decode() for w in batch.column(0).to_pylist()]
            cut = model.encode(texts, out_type=int, num_threads=1)
            lengths = [len(x) for x in cut]
            ids = np.fromiter((i for x in cut for i in x), dtype=np.int64, count=sum(lengths))
            weights = np.repeat(batch.column(1).to_numpy(), lengths)
            np.add.at(total, ids, weights)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["piece", "n"])

    counts = np.zeros(processor(vocabulary).get_piece_size(), dtype=np.int64)
    found = arrow_map(words.filter("c > 0").select("word", "c"), work, "piece bigint, n bigint")
    for row in found.groupBy("piece").agg(F.sum("n").alias("n")).collect():
        counts[row["piece"]] = row["n"]
    return counts


def lm_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str = VOCABULARY,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """One row per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents whose crc32 of the id modulo 10 is 0 are held out; so is a null id. Tokens
    are the words, A-Z lower-cased, and one end. Null and empty texts are just the end.
    Scores are log10 probabilities. An empty table gives no rows; rows that repeat an id
    count as documents each; other columns are not read; bytes that are not UTF-8 count as U+FFFD.
    """
    held_out = F.coalesce(F.pmod(crc_of_id(id_col), F.lit(10)) == 0, F.lit(True))
    text = F.coalesce(valid_text(text_col), F.lit(""))
    documents, size = docs.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    blocks = max(1, -(-documents // block_docs), -(-(size or 0) // BLOCK_BYTES))
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_col), F.crc32(text.cast("binary"))), F.lit(blocks)).cast("int").alias("block"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        (~held_out).alias("train"),
        text.cast("binary").alias("text"),
    )
    by_block = written(
        arrow_map(
            rows.repartition(blocks, "block").sortWithinPartitions("block"), _block_words, "block int, word binary, c bigint"
        ),
        "lm-block-words",
    )
    words = written(by_block.groupBy("word").agg(F.sum("c").alias("c")), "lm-words")
    ends = rows.filter("train").count()
    seen, kinds = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    train_tokens, kinds = seen + ends, kinds + (ends > 0)

    pieces = piece_counts(words, vocabulary)
    log_total = math.log(pieces.sum() + ends + PIECE_SMOOTHING * (len(pieces) + 1))
    log_p = np.log(pieces + PIECE_SMOOTHING) - log_total
    end_lattice = (math.log(ends + PIECE_SMOOTHING) - log_total) / math.log(10)
    word_total = math.log10(train_tokens + WORD_SMOOTHING * (kinds + 1))
    end_base = math.log10(ends + WORD_SMOOTHING) - word_total

    def lattice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Lattice(vocabulary, log_p)
        for batch in batches:
            scores = [model.log_prob(w.decode()) / math.log(10) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["word", "c", "lp"]
            )

    scored_words = arrow_map(words.select("word", "c"), lattice, "word binary, c bigint, lp double")
    answers = by_block.select("block", "word").join(scored_words, "word").select("block", "word", "c", "lp")

    def score(key: tuple, docs_of: pa.Table, answer: pa.Table) -> pa.Table:
        place = {w: k for k, w in enumerate(answer["word"].to_pylist())}
        c = answer["c"].to_numpy()
        base = np.log10(c + WORD_SMOOTHING) - word_total
        marginal = answer["lp"].to_numpy()
        out = {name: [] for name in ("n_tokens", "n_known", "base_score", "score")}
        for text in docs_of["text"]:
            tokens = text.as_py().lower().split()
            at = np.fromiter(map(place.__getitem__, tokens), dtype=np.int64, count=len(tokens))
            out["n_tokens"].append(len(tokens) + 1)
            out["n_known"].append(int((c[at] > 0).sum()) + (ends > 0))
            out["base_score"].append(float(base[at].sum()) + end_base)
            out["score"].append(float(marginal[at].sum()) + end_lattice)
        held = [not x for x in docs_of["train"].to_pylist()]
        return pa.table(
            {"doc_id": docs_of["doc_id"], "held_out": pa.array(held, pa.bool_()),
             "n_tokens": pa.array(out["n_tokens"], pa.int64()), "n_known": pa.array(out["n_known"], pa.int64()),
             "train_tokens": pa.array([train_tokens] * len(held), pa.int64()),
             "base_score": pa.array(out["base_score"], pa.float64()), "score": pa.array(out["score"], pa.float64())}
        )

    return (
        rows.repartition(blocks, "block")
        .groupBy("block")
        .cogroup(answers.repartition(blocks, "block").groupBy("block"))
        .applyInArrow(
            score,
            "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
            "base_score double, score double",
        )
    )
