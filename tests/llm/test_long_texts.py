"""Work per text grows with its length: very long lines, many matches, long runs, each within a bound of time."""

from __future__ import annotations

import base64
import random
import time

import pytest
from pyspark.sql import functions as F

from millwatch.llm import exact_dedup, fingerprints, langid, lm_scoring, ngram_join, packing, secrets


def seconds_of(spark, text, expression):
    """Seconds over the text, once code is compiled; the text comes from a file, so nothing is folded."""
    df = spark.createDataFrame([(text,)], "text string").repartition(1).cache()
    df.count()
    taken = []
    for _ in range(2):
        began = time.time()
        df.select(F.xxhash64(F.to_json(F.struct(expression.alias("x"))))).collect()
        taken.append(time.time() - began)
    df.unpersist()
    return min(taken)


def test_one_long_line(spark):
    line = "".join(random.Random(1).choices("abcdefghij klmnop", k=1 << 22))
    assert seconds_of(spark, line, fingerprints.vector_of(F.col("text"))) < 30


@pytest.mark.parametrize("pieces", [1, 3, 700, 1000])
def test_pieces_of_lines(spark, pieces):
    text = "a\n\n" + "é" * pieces + "\nb\n"
    got = spark.createDataFrame([(text,)], "text string").select(fingerprints.paragraphs(F.col("text"))).first()[0]
    want = [line[i : i + 240] for line in text.split("\n") if line for i in range(0, len(line), 240)]
    assert got == want


def test_many_matches(spark):
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("0123456789abcdef", k=32)) for _ in range(100_000))
    assert seconds_of(spark, text, secrets.spans(F.col("text"), secrets.HEX, 2)) < 60
    found = spark.createDataFrame([(text[:3300],)], "text string").select(secrets.spans(F.col("text"), secrets.HEX, 2)).first()[0]
    assert [(s["start"], s["end"]) for s in found] == [(33 * k, 33 * k + 32) for k in range(100)]


def test_one_long_run(spark):
    run = base64.b64encode(random.Random(3).randbytes(750_000)).decode()
    assert seconds_of(spark, run, secrets.max_entropy(F.col("text"))) < 120


def test_texts_that_are_not_utf8(spark):
    """Bytes that are not UTF-8 are read as U+FFFD; no operator that reads them in Python fails."""
    raw = spark.sql(
        "SELECT id AS doc_id, CAST(concat(X'FF61FE20', CAST(repeat('good word ', CAST(id % 5 AS INT)) AS BINARY), X'C3') AS STRING) "
        "AS text, IF(id % 2 = 0, 'aa', 'bb') AS lang FROM range(40)"
    ).cache()
    good = raw.withColumn("text", F.make_valid_utf8("text"))
    assert raw.filter("NOT is_valid_utf8(text)").count() == 40

    def same(run, *columns):
        a, b = (sorted(map(tuple, run(df).select(*columns).collect()), key=repr) for df in (raw, good))
        assert a == b and a

    same(lm_scoring.lm_scores, "doc_id", "n_tokens", "base_score")
    same(packing.pack, "doc_id", "doc_tokens")
    same(lambda df: langid.identify(df, langid.fit_model(df)), "doc_id", "lang_pred")
    assert exact_dedup.exact_groups(raw).count() == ngram_join.ngram_components(raw).count() == 40
