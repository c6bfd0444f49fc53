"""Spelling variants against brute force on small fixtures."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

from test_llm_operators import awkward, empty

from millwatch.llm import spelling


def brute_words(docs, damage=199, chars=6, least=5):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % damage == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            if len(low) >= chars:
                counts[low] += 1
    return {w: n for w, n in counts.items() if n >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute(words, ratio=5):
    near = defaultdict(list)
    for a in words:
        for b in words:
            if one_edit(a, b):
                near[a].append(b)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def variants(spark, docs, **how):
    found = spelling.spelling_variants(docs, **how)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in found.collect()), key=lambda r: r[0])


def test_words_forms_and_chains(spark):
    """Chains of forms, ties, accents, upper case, damaged runs; missing ids and clashing columns."""
    rng = random.Random(5)
    counts = {"Straßen": 400, "strasen": 70, "strassen": 14, "stÑasen": 13, "strahen": 5, "ÀÉÎÕÜß": 9, "ÀÉÎÕÜ": 30, "Vapour": 4, "abcdef": 5, "bcdefg": 5}
    words = [w if rng.random() < 0.8 else w.upper() if w.isascii() else w for w, n in counts.items() for _ in range(n)]
    rng.shuffle(words)
    texts = [(k if k % 9 else None, " ".join(words[k::40]) + "; 12 x", "c", "c") for k in range(40)]
    docs = spark.createDataFrame([*texts, (1, None, "c", "c"), (1, "", "c", "c")], "doc_id bigint, text string, word string, n string")
    for damage in (3, 199):
        got = variants(spark, docs, damage=damage)
        want = brute(brute_words([(r["doc_id"], r["text"]) for r in docs.collect()], damage=damage))
        assert got == want
    assert any(form not in (None, root) for _, form, root, *_ in got)


def test_crowded_chunks_are_cut_again(spark, monkeypatch):
    """Hundreds of words that share a start or an end, and few letters, so that nearly all are near others."""
    rng = random.Random(8)
    pool = {"".join(rng.choice("ab") for _ in range(rng.randint(2, 9))) for _ in range(400)}
    pool |= {"inter" + "".join(rng.choice("abcé") for _ in range(rng.randint(1, 5))) for _ in range(300)}
    pool |= {"".join(rng.choice("xyz") for _ in range(rng.randint(1, 5))) + "tion" for _ in range(200)}
    pool |= {"q" * 9_000, "q" * 8_999, "q" * 4_500 + "r" + "q" * 4_499}
    words = {w: 1 + k % 7 for k, w in enumerate(sorted(pool)) if len(w) >= 2}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    want = sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))
    for group in (3, 10_000):
        found = spelling.near_words(frame, group=group).collect()
        assert sorted(tuple(sorted((r["a"], r["b"]))) for r in found) == want
        assert all(words[r["a"]] == r["n_a"] and words[r["b"]] == r["n_b"] for r in found)


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    want = brute(brute_words([(r["doc_id"], r["text"]) for r in docs.collect()], chars=2, least=1, damage=2))
    assert variants(spark, docs, chars=2, least=1, damage=2) == want
    assert variants(spark, empty(spark)) == []
