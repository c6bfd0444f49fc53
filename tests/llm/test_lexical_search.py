"""Ranked lexical search against brute force on small fixtures."""

from __future__ import annotations

import math
import re
from collections import Counter

from test_llm_operators import LONG, awkward, empty

from millwatch.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id bigint, text string, doc_id string"


def cut(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    docs = [(i, Counter(cut(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in docs]
    all_docs, all_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in docs for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(cut(t))
    out = []
    for item, terms in wanted.items():
        scored = []
        for (doc_id, c), n in zip(docs, sizes, strict=True):
            score = 0
            for t in terms & c.keys():
                m = 100 - 90 + (90 * n * all_docs) // all_terms
                weight = math.floor(1000 * math.log((2 * all_docs + 2) / (2 * df[t] + 1)))
                score += weight * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, k, d, -s) for k, (s, _, d) in enumerate(scored[:top], 1)]
    return sorted(out, key=repr)


def items_of(spark):
    rows = [
        (0, "a, B; c!", "x"), (1, "w5x5 W7x7 nothing", "x"), (2, "", "x"), (3, None, None), (4, "zzz", "x"), (None, "b", "x"),
        (5, "straße Ünï", "x"), (0, "12", "x"), (0, "a", "x"), (6, LONG, "x"),
    ]
    return spark.createDataFrame(rows, ITEMS)


def ranked(spark, docs, items, **how):
    found = lexical_search.ranked_documents(docs, items, **how)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted([tuple(r) for r in found.collect()], key=repr)


def plain(df, key):
    return [(r[key], r["text"]) for r in df.collect()]


def test_awkward_documents_and_items(spark):
    docs, items = awkward(spark), items_of(spark)
    want = brute(plain(docs, "doc_id"), plain(items, "item_id"))
    assert want and ranked(spark, docs, items) == want
    # Several blocks of items, some documents at a time.
    assert ranked(spark, docs, items, block_chars=30_000) == want
    assert ranked(spark, empty(spark), items) == []
    assert ranked(spark, docs, items.limit(0)) == []


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    """A third of all documents are the same text, over several tasks."""
    texts = ["alpha beta" if i % 3 == 0 else f"alpha {i % 7} gamma, Beta-beta" if i % 3 == 1 else "delta é÷ x" for i in range(300)]
    docs = spark.createDataFrame([(300 - i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(6)
    items = spark.createDataFrame([(1, "beta"), (2, "alpha delta"), (3, "É é÷"), (4, "gamma 3 beta")], "item_id bigint, text string")
    want = brute(plain(docs, "doc_id"), plain(items, "item_id"), top=4)
    monkeypatch.setattr(lexical_search, "ADDITIONS", 50)
    assert ranked(spark, docs, items, top=4) == want


def test_terms_are_whole_and_bytes_need_not_be_text(spark):
    docs = spark.sql(
        "SELECT 1L AS doc_id, CAST(X'FF61FF' AS STRING) AS text UNION ALL SELECT 2L, 'ab a_b ba' UNION ALL SELECT 3L, 'xab abx'"
    )
    items = spark.createDataFrame([(1, "a"), (2, "ab")], "item_id bigint, text string")
    assert [r[:3] for r in ranked(spark, docs, items)] == [(1, 1, 2), (2, 1, 2)]
