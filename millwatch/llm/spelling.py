"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

A word of l characters contributes two disjoint chunks of l // 2 characters, its start and its
end; one edit leaves at least one of them whole. The partner contributes its positional grams:
of all of them only those within shift one of a chunk's place can meet it, and the shift is the
difference of the two lengths, so the shorter word gives chunks and the longer one a gram for
either chunk (words of equal length meet by their chunks). What meets is verified.

A chunk that more than GROUP words share is not compared all with all: one edit lies in the
rest of the word, so the rest is cut into chunks again, until a group is small or one character
is left. So a common syllable costs its words some more keys, not pairs. A pair that several
chunks would bring is taken at the first, so each link comes once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import join_ids, whole_text, written

RUNS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words that are compared all with all, at most; larger groups are cut by further chunks.
GROUP = 64


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, damage: int = 199, chars: int = 6, least: int = 5
) -> DataFrame:
    """(word, n): the distinct damaged words of at least ``chars`` characters and ``least`` occurrences.

    A run whose hash with its document's id is a multiple of ``damage`` loses one character. A
    missing id counts as empty text in that hash. Occurrences are summed before they are shuffled.
    """
    run = F.explode(F.regexp_extract_all(whole_text(f"`{text_col}`"), F.lit(RUNS), F.lit(0)))
    name = F.coalesce(F.col(f"`{id_col}`").cast("bigint").cast("string"), F.lit(""))
    runs = docs.select(name.alias("id"), run.alias("run")).filter(F.length("run") >= chars)
    low = runs.select("id", F.translate("run", UPPER, LOWER).alias("low"))
    hashed = low.select("low", F.crc32(F.concat_ws(":", "id", "low").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("low")).cast("int")
    cut = F.concat(F.left("low", at), F.substr("low", at + 2))
    words = hashed.select(F.when(F.col("h") % damage == 0, cut).otherwise(F.col("low")).alias("word"))
    counted = words.filter(F.length("word") >= chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least)


def _halves(base: Column, own: Column, key: Column) -> Column:
    """The two chunks of a rest whose chunk-giving words have ``base`` characters of it left, ``own`` the word at hand.

    The rest starts at ``start``. ``limit`` says up to where words must not agree, because an
    earlier chunk has brought them together then.
    """
    q, start = F.floor(base / 2).cast("int"), F.col("start")
    chunk = F.substr("word", start + 1, q)
    tail = F.substr("word", start + own - q + 1, q)
    rest = own - q
    return F.array(
        F.struct(
            F.xxhash64(key, F.lit(0), chunk).alias("key"), (start + q).alias("start"), rest.alias("rest"), F.col("limit")
        ),
        F.struct(F.xxhash64(key, F.lit(1), tail).alias("key"), start.alias("start"), rest.alias("rest"), (start + q).alias("limit")),
    )


def _chunked(rows: DataFrame, key: Column) -> DataFrame:
    """``rows`` (word, n, longer, start, rest, limit) with both chunks or grams of what is left."""
    base = F.col("rest") - F.col("longer").cast("int")
    halves = F.explode(_halves(base, F.col("rest"), key))
    return rows.select("word", "n", "longer", halves.alias("c")).select("word", "n", "longer", "c.*")


def near_words(words: DataFrame, *, group: int = GROUP) -> DataFrame:
    """Each pair of words that differ by one inserted, deleted or replaced character: (a, n_a, b, n_b).

    ``words`` holds each word once, of two characters or more.
    """
    length = F.length("word")
    whole = words.select("word", "n", F.lit(0).alias("start"), length.alias("rest"), F.lit(0).alias("limit"))
    roles = whole.withColumn("longer", F.explode(F.array(F.lit(False), F.lit(True))))
    # The key starts with the length of the words that give chunks.
    rows = _chunked(roles, F.col("rest") - F.col("longer").cast("int"))
    links = None
    while True:
        rows = written(rows, "spelling-chunks")
        hot = rows.groupBy("key").agg(
            F.count("*").alias("m"), F.max(F.when(~F.col("longer"), F.col("rest"))).alias("base")
        )
        # One character cannot be cut any more; groups without a chunk-giving word link nothing.
        hot = written(hot.filter((F.col("m") > group) & (F.coalesce("base", F.lit(2)) > 1)), "spelling-hot")
        small = join_ids(rows, hot.select("key"), "key", "left_anti")
        found = written(_verified(small), "spelling-links")
        links = found if links is None else links.unionByName(found)
        again = hot.filter("base IS NOT NULL").select("key")
        if not again.limit(1).count():
            return links
        rows = _chunked(join_ids(rows, again, "key"), F.col("key"))


def _verified(rows: DataFrame) -> DataFrame:
    """Pairs of a group that are one edit apart and that no earlier chunk brings."""
    left = rows.filter("NOT longer").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"), "limit")
    right = rows.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), "longer")
    first = (F.col("limit") == 0) | (F.left("a", F.col("limit")) != F.left("b", F.col("limit")))
    once = F.col("longer") | (F.col("a") < F.col("b"))
    near = F.levenshtein("a", "b", 1) == 1
    return left.join(right, "key").filter(once & first & near).select("a", "n_a", "b", "n_b")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, ratio: int = 5, **words) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n (ties: the smallest) if it has ``ratio`` times the
    word's occurrences, else null; ``root`` is the end of the chain of forms. Null, empty and
    letterless texts hold no words, empty tables no rows; rows that repeat are counted each, and
    a missing id counts as empty text. Words of any length are treated alike. Other columns are
    not read.
    """
    counted = written(word_counts(docs, id_col, text_col, **words), "spelling-words")
    links = near_words(counted)
    both = links.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionByName(
        links.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m"))
    )
    best = F.min(F.struct((-F.col("m")).alias("rank"), "other"))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    judged = counted.join(near, "word", "left")
    formed = F.col("best.rank") <= -ratio * F.col("n")
    judged = written(
        judged.select(
            "word",
            F.when(formed, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(formed, -F.col("best.rank")).alias("form_n"),
        ),
        "spelling-judged",
    )
    roots = _roots(judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    named = judged.join(roots, "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(steps: DataFrame) -> DataFrame:
    """(word, root): each step is joined to the next until none goes on.

    Occurrences grow by the ratio at each step, so chains are short; each round doubles what a
    row has behind it. A form has as many words as there are edits of it, at most.
    """
    while True:
        steps = written(steps, "spelling-roots")
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        if not steps.join(onward, "root", "left_semi").limit(1).count():
            return steps
        steps = steps.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"))
