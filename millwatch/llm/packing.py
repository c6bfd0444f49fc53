"""Bounded-space online packing of token ids into sequences.

Every task reads its documents once and keeps OPEN_WINDOWS windows open. A document's full
windows leave at once; its rest goes to the window it fits best; where none has room, the
head of the rest tops up the fullest window, which is then emitted full. At the end of
its rows a task has less than OPEN_WINDOWS unfinished windows. These leftovers (bounded
per task) are merged by the same rule in fewer tasks, and what is then unfinished is cut
at powers of two, where no padding is due.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from collections.abc import Iterable, Iterator
from itertools import filterfalse, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import arrow_map, valid_text, worker_cache, written

WINDOW = 4096
OPEN_WINDOWS = 16
END_ID = 2
# Tasks whose leftovers one task merges.
MERGED_TASKS = 64
# Words of a generation of the cache; two are held.
CACHED_WORDS = 150_000
_MARKS = string.punctuation.encode()
# Letters that are the same lower-cased and composed, and words of them in UTF-8.
_LATIN = string.ascii_lowercase + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
_LATIN_WORD = re.compile(rb"(?:[a-z]|\xC3[\x9F-\xB6\xB8-\xBF])+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# First sequence id of the merged leftovers; ids below it hold the task in their upper bits.
_MERGED = 1 << 62


class WordIds:
    """Token ids of UTF-8 texts, word by word (split at ASCII white space only).

    The tokenizer drops white space and never merges across it, so a text's ids are its
    words' ids one after the other. Words are cached in two generations: a full one becomes
    the old one, from which words that come again are taken over, so frequent words stay.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, dtype=bool)  # ids that close a pre-token
        self.ends[[i for t, i in names.items() if t.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.raw = [i.to_bytes(4, "little") for i in range(len(self.ends))]
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # What the model is given for a Latin word, letter by letter; none if this tokenizer treats them otherwise.
        self.letters: dict[int, str] | None = None
        self.same_ascii = False  # whether a-z stand for themselves there
        before, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if before and cut and before.normalize_str(_LATIN) == _LATIN and not any(a.isalpha() for a in self.added):
            letters = {ord(c): cut.pre_tokenize_str(c)[0][0] for c in _LATIN}
            if [piece for piece, _ in cut.pre_tokenize_str(_LATIN)] == [_LATIN.translate(letters)]:
                self.letters = letters
                self.same_ascii = all(letters[ord(c)] == c for c in string.ascii_lowercase)

    def _lower(self, text: bytes) -> bytes:
        """A-Z lower-cased, as the tokenizer does, where this cannot change what is composed or found whole."""
        if b"\xcc" in text or b"\xcd" in text:  # U+0300 to U+037F: marks that compose with letters
            return text
        low = text.lower()
        return text if any(a in low for a in self.added) else low

    def _encode(self, words: list[bytes]) -> None:
        """Latin words go to the model as they are; other words of letters are one pre-token each and share calls."""
        if self.letters:
            tokenize, raw, rest = self.tokenizer.model.tokenize, self.raw, []
            latin, same, letters, known = _LATIN_WORD.fullmatch, self.same_ascii, self.letters, self.known
            for w in words:
                if latin(w):
                    given = w.decode() if same and w.isascii() else w.decode().translate(letters)
                    known[w] = b"".join([raw[t.id] for t in tokenize(given)])
                else:
                    rest.append(w)
            words = rest
        plain = [w for w in words if w.decode().isalpha()]
        for start in range(0, len(plain), 2000):
            some = plain[start : start + 2000]
            ids = np.array(self.tokenizer.encode(b" ".join(some).decode(), add_special_tokens=False).ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some):  # a letter that lower case or composition takes apart
                self._encode_each(some)
                continue
            raw, at = ids.tobytes(), 0
            for w, stop in zip(some, stops.tolist(), strict=True):
                self.known[w] = raw[4 * at : 4 * stop]
                at = stop
        self._encode_each(list(set(words).difference(plain)))

    def _encode_each(self, words: list[bytes]) -> None:
        for start in range(0, len(words), 2000):
            some = words[start : start + 2000]
            for w, e in zip(some, self.tokenizer.encode_batch([w.decode() for w in some], add_special_tokens=False), strict=True):
                self.known[w] = np.array(e.ids, dtype="<u4").tobytes()

    def _unknown(self, words: Iterable[bytes]) -> set[bytes]:
        """Those in neither generation; what the old one holds is taken over."""
        new = set(filterfalse(self.known.__contains__, words))
        again = [w for w in new if w in self.old]
        self.known.update(zip(again, map(self.old.__getitem__, again), strict=True))
        new.difference_update(again)
        return new

    def ids(self, texts: list[bytes]) -> list[bytes]:
        if not texts:
            return []
        low = pa.array([self._lower(t) if self.letters else t for t in texts], pa.binary()).cast(pa.string())
        split = pc.ascii_split_whitespace(low)
        # Each distinct word is looked up once; all words are then laid out by its number.
        coded = pc.dictionary_encode(split.flatten())
        words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > CACHED_WORDS:
            self.known, self.old = {}, self.known
        # A word of letters with marks behind it is its letters' ids and the marks' ids. (Beyond U+FFFF the
        # tokenizer's and Python's ideas of a letter may differ.)
        tails: list[tuple[bytes, bytes, bytes]] = []
        whole, parts = [], set()
        for w in self._unknown(words):
            head = w.rstrip(_MARKS)
            if len(head) < len(w) and (head.isalpha() or (head and max(head) < 0xF0 and head.decode().isalpha())):
                tails.append((w, head, w[len(head) :]))
                parts.update(tails[-1][1:])
            else:
                whole.append(w)
        self._encode(list(self._unknown(parts).union(whole)))
        for w, head, marks in tails:
            self.known[w] = self.known[head] + self.known[marks]
        found = [self.known[w] for w in words]
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        numbers = coded.indices.to_numpy(zero_copy_only=False)
        stops = np.concatenate([[0], np.cumsum(lengths[numbers])])
        shift = (np.cumsum(lengths) - lengths)[numbers] - stops[:-1]
        places = np.repeat(shift, lengths[numbers]) + np.arange(stops[-1])
        raw = memoryview(np.frombuffer(b"".join(found), "<u4")[places].tobytes())
        ends = (4 * stops[split.offsets.to_numpy()]).tolist()
        return [bytes(raw[a:b]) for a, b in pairwise(ends)]


def word_ids(path: str) -> WordIds:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return worker_cache(("packing", path), lambda: WordIds(path))


class Packer:
    """Open windows of one task. Pieces are (document row, start, ids)."""

    def __init__(self, window: int, most_open: int):
        self.window, self.most_open = window, most_open
        self.open: list[tuple[int, list]] = []  # (tokens, pieces)

    def add(self, doc: tuple, start: int, ids: bytes) -> Iterator[list]:
        """Places ids (4 bytes each) that follow on from ``start``; yields finished windows."""
        n, at = len(ids) // 4, 0
        while n - at >= self.window:
            yield [(doc, start + at, ids[4 * at : 4 * (at + self.window)])]
            at += self.window
        while at < n:
            need = n - at
            fits = [k for k, (used, _) in enumerate(self.open) if self.window - used >= need]
            if fits:
                best = max(fits, key=lambda k: self.open[k][0])
                take = need
            elif len(self.open) < self.most_open:
                self.open.append((0, []))
                best, take = len(self.open) - 1, need
            else:
                best = max(range(len(self.open)), key=lambda k: self.open[k][0])
                take = self.window - self.open[best][0]
            used, pieces = self.open[best]
            pieces.append((doc, start + at, ids[4 * at : 4 * (at + take)]))
            self.open[best] = (used + take, pieces)
            at += take
            if used + take == self.window:
                yield self.open.pop(best)[1]

    def rest(self) -> list[list]:
        return [pieces for _, pieces in self.open]


def power_cut(pieces: list, window: int) -> Iterator[list]:
    """Pieces of an unfinished window as sequences whose lengths are powers of two."""
    total = sum(len(p[2]) // 4 for p in pieces)
    queue, at = list(pieces), 0
    for bit in reversed(range(window.bit_length())):
        if not total >> bit & 1:
            continue
        room, out = 1 << bit, []
        while room:
            doc, start, ids = queue[at]
            take = min(room, len(ids) // 4)
            out.append((doc, start, ids[: 4 * take]))
            room -= take
            if 4 * take == len(ids):
                at += 1
            else:
                queue[at] = (doc, start + take, ids[4 * take :])
        yield out


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("token_ids", pa.binary()),
    ]
)
_DDL = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, token_ids binary"
)


class _Rows:
    """Collects piece rows into record batches."""

    def __init__(self, keep_ids: bool):
        self.keep_ids, self.columns = keep_ids, {name: [] for name in _SCHEMA.names}

    def add(self, sequence: int | None, pieces: list, keep_ids: bool) -> None:
        offset, c = 0, self.columns
        for (doc_id, doc_tokens), start, ids in pieces:
            n = len(ids) // 4
            values = (doc_id, start, n, zlib.crc32(ids), doc_tokens, sequence, offset, ids if keep_ids else None)
            for name, value in zip(_SCHEMA.names, values, strict=True):
                c[name].append(value)
            offset += n

    def full(self, rows: int = 10_000) -> bool:
        return len(self.columns["doc_id"]) >= rows

    def take(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_pydict(self.columns, _SCHEMA)
        self.columns = {name: [] for name in _SCHEMA.names}
        return out


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str = TOKENIZER,
    window: int = WINDOW, most_open: int = OPEN_WINDOWS, keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its whole text, then END_ID. Null and empty texts are that
    one id. Rows that repeat an id are documents each. ``keep_ids`` adds the ids as
    little-endian unsigned 32-bit integers (column ``token_ids``). ``window`` is a power
    of two. An empty table has no pieces; other columns are not read.
    """
    end = np.array([END_ID], dtype="<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, rows = word_ids(tokenizer), Packer(window, most_open), _Rows(keep_ids)
        sequence = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                some = batch.slice(first, 500)
                texts = [t or b"" for t in some.column(1).to_pylist()]
                for doc_id, ids in zip(some.column(0).to_pylist(), encoder.ids(texts), strict=True):
                    ids += end
                    for pieces in packer.add((doc_id, len(ids) // 4), 0, ids):
                        rows.add(sequence, pieces, keep_ids)
                        sequence += 1
                if rows.full():
                    yield rows.take()
        for pieces in packer.rest():  # no sequence yet
            rows.add(None, pieces, keep_ids=True)
        yield rows.take()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, rows = Packer(window, most_open), _Rows(keep_ids)
        sequence = None
        for batch in batches:
            for r in batch.to_pylist():
                if sequence is None:
                    sequence = _MERGED + (r["_group"] << 32)
                for pieces in packer.add((r["doc_id"], r["doc_tokens"]), r["start"], r["token_ids"]):
                    rows.add(sequence, pieces, keep_ids)
                    sequence += 1
                if rows.full():
                    yield rows.take()
        for open_pieces in packer.rest():
            for pieces in power_cut(open_pieces, window):
                rows.add(sequence, pieces, keep_ids)
                sequence += 1
        yield rows.take()

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), valid_text(text_col).cast("binary").alias("text"))
    placed = arrow_map(narrow, work, _DDL).withColumn("_task", F.spark_partition_id())
    placed = written(placed, "packed")
    done = placed.filter("sequence_id IS NOT NULL").drop("_task")
    leftovers = placed.filter("sequence_id IS NULL").withColumn(
        "_group", F.floor(F.col("_task") / MERGED_TASKS)
    )
    groups = max(1, -(-(leftovers.agg(F.max("_task")).first()[0] or 0) // MERGED_TASKS) + 1)
    # One task per group: a group's rows are bounded by MERGED_TASKS x OPEN_WINDOWS windows.
    merged = arrow_map(
        leftovers.repartitionByRange(groups, "_group").sortWithinPartitions("_group", "doc_id", "start", "ids_crc32"),
        merge,
        _DDL,
    )
    out = done.unionByName(merged)
    return out if keep_ids else out.drop("token_ids")
