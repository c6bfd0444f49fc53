"""Language identification: averaged hashed subword embeddings with a linear softmax.

Words and their character n-grams hash into one embedding table; a text is the average of
its subwords' embeddings and a linear softmax names the language. Training is stochastic
gradient descent in numpy over a sample of labelled rows whose size is a parameter; the
prediction reads every whole text. A temperature calibrates the probabilities and texts
below a threshold are rejected.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import arrow_map, crc_of_id, valid_text, worker_cache

# Expected number of labelled rows of each language that the fit reads, at most.
ROWS_PER_LANGUAGE = 1500
BUCKETS, DIM = 1 << 15, 16
NGRAMS = (2, 3, 4)
EPOCHS, RATE, BATCH = 6, 20.0, 32
# Share of rightly named calibration texts that may fall below the rejection threshold.
REJECTED_SHARE = 0.0005
MOST_CONFIDENT_THRESHOLD = 0.5
CACHED_WORDS = 100_000
UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for m in _LETTERS.finditer(text) for c in m.group())


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and their n-grams, and for each the position of its word.

    Words carry marks for begin and end. All words are hashed at once.
    """
    marked = [f"<{w}>" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    of = np.repeat(np.arange(len(words)), [len(m) for m in marked])
    whole = [zlib.crc32(m.encode("utf-8", "surrogatepass")) for m in marked]
    ids, owner = [np.array(whole, dtype=np.uint64) % BUCKETS], [np.arange(len(words))]
    for n in NGRAMS:
        if len(codes) < n:
            continue
        last = len(codes) - n + 1
        h = np.full(last, n, dtype=np.uint64)
        for k in range(n):
            h = (h ^ codes[k : k + last]) * _MIX
            h ^= h >> np.uint64(29)
        inside = of[:last] == of[n - 1 :]
        ids.append(h[inside] % np.uint64(BUCKETS))
        owner.append(of[:last][inside])
    return np.concatenate(ids).astype(np.int64), np.concatenate(owner)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (BUCKETS, languages): embedding times softmax weights
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def word_rows(self, words: list[str]) -> np.ndarray:
        """For each word the sum of its subwords' rows, and how many they are."""
        ids, owner = subwords(words)
        sums = [np.bincount(owner, self.table[ids, k], len(words)) for k in range(len(self.languages))]
        return np.stack([*sums, np.bincount(owner, minlength=len(words))], axis=1)

    def predict(self, texts: list[str], cache: WordCache) -> np.ndarray:
        """Probabilities of each text; every word is hashed once per Python worker."""
        out = np.empty((len(texts), len(self.languages)))
        for k, text in enumerate(texts):
            total = cache.rows_of(words_of(text), self).sum(axis=0)
            out[k] = total[:-1] / max(total[-1], 1.0) + self.bias
        return softmax(out / self.temperature)


class WordCache:
    """Rows of the words seen so far, at most CACHED_WORDS plus one text's."""

    def __init__(self, width: int):
        self.place: dict[str, int] = {}
        self.rows = np.empty((1024, width))

    def rows_of(self, words: list[str], model: Model) -> np.ndarray:
        if len(self.place) > CACHED_WORDS:
            self.place.clear()
        new = list(set(words).difference(self.place))
        if new:
            start, end = len(self.place), len(self.place) + len(new)
            if end > len(self.rows):
                grown = np.empty((max(end, 2 * len(self.rows)), self.rows.shape[1]))
                grown[:start] = self.rows[:start]
                self.rows = grown
            self.rows[start:end] = model.word_rows(new)
            self.place.update(zip(new, range(start, end), strict=True))
        return self.rows[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))]


def cache_for(model: Model) -> WordCache:
    """The cache of the model that this Python worker used last; a worker serves many tasks."""
    key = hashlib.sha1(model.table.tobytes()).digest()
    return worker_cache(("langid", key), lambda: WordCache(len(model.languages) + 1))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], seed: int = 1) -> Model:
    """Fit on the given rows; every fifth of them is held back for calibration."""
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    # A text as its distinct subwords and their shares.
    bags = []
    for text in texts:
        ids, _ = subwords(words_of(text))
        kinds, counts = np.unique(ids, return_counts=True)
        bags.append((kinds, (counts / max(1, len(ids))).astype(np.float32)))
    embed = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    weight = np.zeros((DIM, len(languages)), dtype=np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    fold = np.arange(len(texts)) % 5 == 4
    fit, held = np.flatnonzero(~fold), np.flatnonzero(fold)
    steps = max(1, EPOCHS * len(fit))
    done = 0
    for _ in range(EPOCHS):
        for k in rng.permutation(fit):
            kinds, share = bags[k]
            rate = RATE * (1 - done / steps)
            done += 1
            if not len(kinds):
                continue
            rows = embed[kinds]
            hidden = share @ rows
            logits = hidden @ weight + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[target[k]] -= 1.0
            back = weight @ p
            weight -= (0.1 * rate) * np.outer(hidden, p)
            bias -= 0.01 * rate * p
            embed[kinds] = rows - rate * share[:, None] * back
    model = Model(languages, (embed @ weight).astype(np.float64), bias.astype(np.float64))
    calibrate(model, [bags[k] for k in held], target[held])
    return model


def calibrate(model: Model, bags: list, target: np.ndarray) -> None:
    """Temperature of least log loss, then the threshold that rightly named texts almost all pass."""
    if not len(target):
        return
    logits = np.array([share @ model.table[kinds] + model.bias for kinds, share in bags])
    best = np.inf
    for t in np.geomspace(0.25, 16, 25):
        p = softmax(logits / t)[np.arange(len(target)), target]
        loss = -np.log(np.maximum(p, 1e-12)).mean()
        if loss < best:
            best, model.temperature = loss, float(t)
    p = softmax(logits / model.temperature)
    right = p.max(1)[p.argmax(1) == target]
    if len(right):
        model.threshold = float(min(np.quantile(right, REJECTED_SHARE) * 0.9, MOST_CONFIDENT_THRESHOLD))


def fit_model(
    labelled: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> Model:
    """Train on a sample of the labelled rows.

    Rows without text or label do not count. A language of up to ``rows_per_language``
    rows is read whole; of a larger one, rows whose hash of id and text is low enough for that many to be
    expected. The sample is the same in every run. Whole texts are used.
    """
    rows = labelled.select(
        valid_text(text_col).alias("text"), F.col(label_col).cast("string").alias("label"),
        F.pmod(F.xxhash64(F.col(id_col), F.crc32(valid_text(text_col).cast("binary"))), F.lit(1 << 30)).alias("draw"),
    ).filter("text IS NOT NULL AND label IS NOT NULL")
    share = F.broadcast(
        rows.groupBy("label").agg(((F.lit(rows_per_language) / F.count("*")) * (1 << 30)).alias("below"))
    )
    sample = rows.join(share, "label").filter("draw < below").select("text", "label", "draw").toPandas()
    sample = sample.sort_values(["draw", "label", "text"], ignore_index=True)
    return train(sample["text"].tolist(), sample["label"].tolist())


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, lang_pred, score, rejected.

    A null text or one without a letter is ``und`` with score 0 and is rejected; so is every
    text if the model knows no language. The score is the calibrated probability of the named language. Repeated
    rows repeat their result. Only id and text are read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = cache_for(model)
        for batch in batches:
            texts = [t if has_letter(t) else None for t in batch.column(1).to_pylist()]
            sure = [k for k, t in enumerate(texts) if t is not None and model.languages]
            lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if sure:
                p = model.predict([texts[k] for k in sure], cache)
                for k, best, value in zip(sure, p.argmax(1), p.max(1), strict=True):
                    lang[k], score[k] = model.languages[best], min(1.0, float(value))
            rejected = [x == UNDETERMINED or s < model.threshold for x, s in zip(lang, score, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), valid_text(text_col).alias("text"))
    return arrow_map(narrow, work, "doc_id bigint, lang_pred string, score double, rejected boolean")


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows to learn from: all but those whose crc32 of the id modulo 4 is 2."""
    return docs.filter(F.coalesce(F.pmod(crc_of_id(id_col), F.lit(4)) != 2, F.lit(False)))
