"""Embedding near-dedup against brute force: all links of small tables, recall over whole ones."""

from __future__ import annotations

import math

import numpy as np
from test_llm_operators import FOLDER

from millwatch.llm import vector_graph
from millwatch.llm.common import table

DDL = "vec_id bigint, embedding array<float>, label int, v string, node string, n_links string"


def brute(data, least=0.9):
    """vec_id, n_links, component_id, kept per row, in the order of ``data``."""
    usable = [
        i for i, (key, v) in enumerate(data)
        if key is not None and v and all(e is not None and math.isfinite(e) for e in v) and any(v)
    ]
    links = {i: [] for i in range(len(data))}
    for length in {len(data[i][1]) for i in usable}:
        some = np.array([i for i in usable if len(data[i][1]) == length])
        x = np.array([np.array(data[i][1], dtype=float) / max(map(abs, data[i][1])) for i in some])
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        for a, b in zip(*np.nonzero(x @ x.T >= least), strict=True):
            if a != b:
                links[some[a]].append(some[b])
    out, component = [], {}
    for i in sorted(range(len(data)), key=lambda i: (data[i][0] is None, data[i][0])):
        if i in component:
            continue
        component[i] = data[i][0]
        front = [i]
        while front:
            for j in links[front.pop()]:
                if j not in component:
                    component[j] = data[i][0]
                    front.append(j)
    for i, (key, _) in enumerate(data):
        out.append((key, len(links[i]), component[i], key == component[i] if key is not None else True))
    return sorted(out, key=repr)


def groups(rng, sizes, dims, noise):
    for size in sizes:
        centre = rng.normal(size=dims)
        for _ in range(size):
            yield (centre + noise * rng.normal(size=dims)).astype(np.float32).tolist()


def judged(spark, data, **how):
    frame = spark.createDataFrame([(k, v, 1, "clash", "clash", "clash") for k, v in data], DDL).repartition(3)
    found = vector_graph.near_vectors(frame, **how)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_odd_vectors(spark):
    """Nulls, zeros, non-finite parts, huge and tiny values, several lengths, copies, repeated ids."""
    rng = np.random.default_rng(3)
    some = list(groups(rng, [5, 3, 1, 1], 8, 0.05))
    data = [(100 - k, v) for k, v in enumerate(some)]
    data += [(50, some[0]), (51, some[0]), (50, some[5]), (None, some[0]), (None, None), (7, None), (8, []), (9, [0.0] * 8)]
    data += [(10, [None, *some[0][1:]]), (11, [float("nan"), *some[0][1:]]), (12, [float("inf"), *some[0][1:]])]
    data += [(13, [1e30 * e for e in some[0]]), (14, [1e-30 * e for e in some[0]]), (15, some[0][:4]), (16, some[1][:4]), (7, None)]
    assert judged(spark, data) == brute([(k, v and np.array(v, dtype=np.float32).tolist() if v and None not in v else v) for k, v in data])
    assert judged(spark, []) == []


def test_links_of_crowded_shards(spark, monkeypatch):
    """A third of the rows are near copies, another part exact ones; shards are tiny, so clusters are cut again."""
    monkeypatch.setattr(vector_graph, "SHARD", 400)
    monkeypatch.setattr(vector_graph, "SAMPLE", 300)
    rng = np.random.default_rng(4)
    vectors = list(groups(rng, [300, 20, 20, *[2] * 60, *[1] * 300], 24, 0.15))
    vectors += [vectors[310]] * 200
    data = [(k, v) for k, v in zip(rng.permutation(len(vectors)).tolist(), vectors, strict=True)]
    got, want = judged(spark, data), brute(data)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(r[1] for r in got) >= 0.95 * sum(r[1] for r in want)


def test_vectors_that_no_centre_parts_are_dealt_by_hash(spark, monkeypatch):
    monkeypatch.setattr(vector_graph, "SHARD", 40)
    monkeypatch.setattr(vector_graph, "ROUNDS", 2)
    monkeypatch.setattr(vector_graph, "MOST_OVERLAP", 2)
    data = [(k, [float(k + 1), 0.0]) for k in range(120)]
    got = judged(spark, data)
    assert len(got) == 120 and all(0 < r[1] <= 119 for r in got)


def test_query_recall(spark):
    """All rows whose id is divisible by 100, against all rows."""
    rows = table(spark, FOLDER, "embeddings")
    data = [(r["vec_id"], r["embedding"]) for r in rows.collect()]
    # Near copies of some rows, since the small table holds none.
    rng = np.random.default_rng(5)
    data += [(10_000 + k, (np.array(v) + 0.02 * rng.normal(size=len(v))).tolist()) for k, v in data[:200]]
    found = {r[0]: r for r in judged(spark, data)}
    queries = [(k, v) for k, v in data if k % 100 == 0]
    truth = vector_graph.brute_counts(spark.createDataFrame(data, "vec_id bigint, v array<double>"), queries, 0.9)
    assert sum(truth.values()) > len(queries)
    assert sum(found[k][1] for k, _ in queries) >= 0.9 * sum(truth[k] - 1 for k, _ in queries)


def test_no_link_is_lost_between_shards(spark, monkeypatch):
    """Groups of near vectors larger than a shard, chains, and vectors that are dealt by hash; in one block and in many."""
    monkeypatch.setattr(vector_graph, "SHARD", 40)
    monkeypatch.setattr(vector_graph, "SAMPLE", 40)
    monkeypatch.setattr(vector_graph, "ROUNDS", 2)
    monkeypatch.setattr(vector_graph, "MOST_OVERLAP", 2)
    rng = np.random.default_rng(6)
    vectors = list(groups(rng, [200, 30, *[2] * 20, *[1] * 100], 24, 0.2))
    vectors += [[math.cos(a), math.sin(a)] for a in np.arange(0, 4, 0.04).tolist()]
    vectors += [[float(k + 1), 0.0, 0.0] for k in range(120)] + [vectors[0]] * 5
    data = [(k, np.array(v, dtype=np.float32).tolist()) for k, v in zip(rng.permutation(len(vectors)).tolist(), vectors, strict=True)]
    want = brute(data)
    assert judged(spark, data) == want
    monkeypatch.setattr(vector_graph, "BLOCK", 24 * 30)
    assert judged(spark, data) == want


def test_narrow_cells_leave_nothing_to_visit(spark, monkeypatch):
    """Clusters far apart, several to a cell: no vector visits another block, and all links are found."""
    monkeypatch.setattr(vector_graph, "SHARD", 200)
    monkeypatch.setattr(vector_graph, "SAMPLE", 200)
    monkeypatch.setattr(vector_graph, "BLOCK", 64 * 100)
    visitors = spark.sparkContext.accumulator(0)
    visits = vector_graph._visits

    def counted(least):
        def work(batches):
            for batch in visits(least)(batches):
                visitors.add(batch.num_rows)
                yield batch

        return work

    monkeypatch.setattr(vector_graph, "_visits", counted)
    data = list(enumerate(groups(np.random.default_rng(7), [20] * 30, 64, 0.1)))
    assert judged(spark, data) == brute(data)
    assert visitors.value < len(data)


def test_doubles_keep_their_precision(spark):
    """A cosine on either side of the threshold by less than a float can tell."""
    def at(cosine):
        return [cosine, math.sqrt(1 - cosine * cosine)]

    frame = spark.createDataFrame([(1, [1.0, 0.0]), (2, at(0.9 + 1e-12)), (3, at(0.9 - 1e-12))], "vec_id bigint, embedding array<double>")
    links = {r[0]: r[1] for r in vector_graph.near_vectors(frame).collect()}
    assert links == {1: 1, 2: 2, 3: 1}
