"""Half-space anomaly scores against a plain count of leaf masses."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millwatch.operators import forest
from millwatch.plans import features


@pytest.fixture(scope="module")
def rows(fleet):
    return features.features(fleet.telemetry, fleet.registry, rolling=False)


def test_scores_equal_plain_counting(rows):
    trees, depth = 12, 6
    placed = rows.select("reading_id", *[p.alias(f"p{n}") for n, p in enumerate(forest.positions())]).collect()
    got = {r["reading_id"]: r["anomaly_score"] for r in forest.anomaly_scores(rows, trees=trees, depth=depth).collect()}
    assert len(got) == len(placed)

    def leaf(row, tree):
        a, b, ka, kb, sa, sb = forest.tree_shape(tree, depth)
        if row[f"p{a}"] is None or row[f"p{b}"] is None:
            return None
        bins = [((row[f"p{n}"] + s) << k) // (2 * forest.SPAN) for n, k, s in ((a, ka, sa), (b, kb, sb))]
        return tree, *bins

    mass = Counter(leaf(r, t) for r in placed for t in range(trees))
    for r in placed:
        found = [leaf(r, t) for t in range(trees) if leaf(r, t)]
        if not found:
            assert got[r["reading_id"]] is None
            continue
        bits = sum(mass[x].bit_length() for x in found)
        assert got[r["reading_id"]] == 1.0 - bits / (len(found) * len(placed).bit_length())


def test_every_reading_is_scored_and_outliers_stand_out(rows):
    odd = rows.filter("temperature_c IS NOT NULL AND pressure_bar IS NOT NULL").limit(1).select(
        *[F.lit(-1).cast("bigint").alias(c) if c == "reading_id"
          else F.lit(900).cast("decimal(7,2)").alias(c) if c in ("temperature_c", "pressure_bar") else F.col(c)
          for c in rows.columns]
    )
    scored = forest.anomaly_scores(rows.unionByName(odd))
    assert scored.count() == rows.count() + 1
    best = scored.orderBy(F.desc_nulls_last("anomaly_score")).limit(20).collect()
    assert -1 in [r["reading_id"] for r in best]


def test_no_python_and_bounded_broadcast(rows):
    plan = forest.anomaly_scores(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_empty_input(rows):
    assert forest.anomaly_scores(rows.limit(0)).collect() == []
