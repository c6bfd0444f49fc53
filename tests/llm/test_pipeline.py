"""The corpus pipeline stage by stage against brute force, and over awkward and empty tables."""

from __future__ import annotations

import re
import weakref
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_llm_operators import FOLDER, awkward, brute_components, brute_targets, empty

import corpus_pipeline
from millwatch.llm import common, langid, ngram_join, packing


@pytest.fixture(scope="module")
def outputs(spark):
    """Each stage over all that the stage before it kept."""
    docs, out = common.table(spark, FOLDER, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, FOLDER), f"test-{name}")
        out.append(docs)
    return out


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_stages_keep_the_columns(spark, outputs):
    columns = common.table(spark, FOLDER, "documents").columns
    assert all(df.columns == columns for df in outputs[:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]


def test_language_stage_keeps_clean_documents(spark, outputs):
    before = common.table(spark, FOLDER, "documents").filter("text RLIKE '[A-Za-z]'").count()
    assert outputs[0].count() >= 0.99 * before


def test_exact_stage(outputs):
    before, after = rows(outputs[0].select("doc_id", "text")), rows(outputs[1].select("doc_id", "text"))
    first = {}
    for doc_id, text in sorted(before):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), doc_id)
    assert sorted(i for i, _ in after) == sorted(first.values())


def test_near_stage(outputs):
    before, after = rows(outputs[1].select("doc_id", "text")), rows(outputs[2].select("doc_id"))
    components = brute_components(before, 5, 80, 100)
    assert sorted(i for (i,) in after) == sorted({c for _, _, c in components})


def test_mixing_stage(outputs):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    before, after = rows(outputs[2].select("doc_id", "text", "source")), rows(outputs[3].select("doc_id"))
    times = Counter(i for (i,) in after)
    sizes, taken, longest = Counter(), Counter(), Counter()
    for i, t, s in before:
        sizes[s] += size(t)
        taken[s] += times[i] * size(t)
        longest[s] = max(longest[s], size(t))
    for s, target in brute_targets(sizes).items():
        assert abs(taken[s] - target) <= longest[s]
    assert times.keys() <= {i for i, _, _ in before} and set(times.values()) <= {1, 2}


def test_packing_stage(outputs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    want = Counter()
    for i, t in rows(outputs[3].select("doc_id", "text")):
        want[i] += len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
    got, used = Counter(), defaultdict(int)
    for r in outputs[4].collect():
        got[r["doc_id"]] += r["length"]
        used[r["sequence_id"]] += r["length"]
    assert got == want
    assert all(n <= packing.WINDOW and n & (n - 1) == 0 for n in used.values())


def test_run_equals_the_stages(spark, outputs):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == outputs[4].columns
    want = Counter((r["doc_id"], r["doc_tokens"]) for r in outputs[4].filter("start = 0").collect())
    assert Counter((r["doc_id"], r["doc_tokens"]) for r in got.filter("start = 0").collect()) == want


def test_a_worker_holds_the_words_of_one_stage():
    """A Python worker that serves all stages in turn lets go of the stage before."""
    model = langid.Model(["de", "en"], np.zeros((langid.BUCKETS, 2)), np.zeros(2))
    words = weakref.ref(langid.cache_for(model))
    assert langid.cache_for(model) is words()
    ngram_join.shingles(b"some words of a text", 3)
    assert words() is None
    encoder = weakref.ref(packing.word_ids(packing.TOKENIZER))
    assert packing.word_ids(packing.TOKENIZER) is encoder()
    langid.cache_for(model)
    assert encoder() is None


def test_stages_over_awkward_and_empty_tables(spark):
    for make in (awkward, empty):
        docs = make(spark)
        for name, stage in corpus_pipeline.STAGES:
            # Labels are missing for most rows here, so the first stage may well reject all.
            out = common.written(stage(spark, docs, FOLDER), f"odd-{name}")
            if name != "language_id":
                assert (out.count() > 0) == (make is awkward)
            if name not in ("language_id", "packing"):
                assert out.columns == docs.columns
                docs = out
