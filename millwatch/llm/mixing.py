"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length within their source. A source's target is met by
whole rounds over all its documents plus a rest, which an even share of each length
covers up to rounding; the remaining budget is fitted by bounded-knapsack dynamic
programming over the leftover counts. Documents of a length are then chosen in seeded
order. The histogram, not the documents, is what a task holds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwatch.llm.common import WORDS, whole_text, written
from millwatch.operators.ranking import ranked

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_ROUNDS = 2
SEED = 17
# A length's documents are counted and chosen in this many seeded parts, so that a length
# which holds a third of all rows is spread over as many tasks.
PARTS = 256
# The dynamic programme fits the last so many words, or the longest free document if that is
# longer; what exceeds them is first taken greedily.
DP_WORDS = 1 << 14


def n_words(text_col: str = "text") -> Column:
    return F.regexp_count(whole_text(text_col), F.lit(WORDS)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MAX_ROUNDS) -> DataFrame:
    """(source, source_size, target) from ``sizes`` (source, source_size).

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share``
    of all words. A target stops at ``most`` times the source's size; the excess is
    reshared by weight until none is above. Each round ends in two sums over the sources.
    """
    at_most = sizes.count()
    order = [F.asc_nulls_last("source")]
    numbered = ranked(sizes, "_place", order, at_most=at_most)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("_place") - 1, len(weights)))
    rows = numbered.select("source", "source_size", weight.alias("_w"), (F.col("source_size") * most).alias("_cap"))
    budget = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0  # words per unit of weight; only ever rises
    while True:
        full = F.col("_w") * F.lit(level) > F.col("_cap")
        capped, open_weight = rows.agg(
            F.sum(F.when(full, F.col("_cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("_w")))
        ).first()
        if not open_weight or (budget - capped) / open_weight <= level * (1 + 1e-12):
            break
        level = (budget - capped) / open_weight
    target = F.least(F.col("_w") * F.lit(level), F.col("_cap").cast("double"))
    return rows.select("source", "source_size", target.alias("target"))


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come closest to ``budget``
    from below.

    An even share of each length first, then more of the longest while more than DP_WORDS (and
    than the longest free document) stay missing, then exact subset sums over the counts left
    for all that is missing. What stays missing is less than the shortest free document.
    """
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros_like(counts)
    if budget >= total:
        return counts.copy()
    taken = np.floor(counts * (budget / total)).astype(counts.dtype)
    left = budget - int((lengths * taken).sum())
    order = np.argsort(-lengths, kind="stable")
    exact = max(DP_WORDS, int(lengths[counts > taken].max(initial=0)))
    for i in order:
        if left <= exact:
            break
        if lengths[i]:
            more = min(int(counts[i] - taken[i]), (left - exact) // int(lengths[i]))
            taken[i] += more
            left -= more * int(lengths[i])
    # Bit s of ``reach`` says whether s words can be made; each length enters as 1, 2, 4, ... copies.
    # ``left`` is now below ``exact`` plus the shortest free length. Copies that make no new sum are not kept.
    mask = (1 << (left + 1)) - 1
    reach, layers = 1, []
    for i in order:
        n = int(lengths[i])
        free = min(int(counts[i] - taken[i]), left // n if n else 0)
        power = 1
        while free > 0 and not reach >> left & 1:
            copies = min(power, free)
            more = reach | (reach << copies * n) & mask
            if more != reach:
                layers.append((i, copies, reach))
            reach = more
            free -= copies
            power *= 2
    at = reach.bit_length() - 1
    for i, copies, before in reversed(layers):
        if not before >> at & 1:
            taken[i] += copies
            at -= copies * int(lengths[i])
    return taken


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size", ignore_index=True)
    lengths, counts = rows["size"].to_numpy("int64"), rows["n"].to_numpy("int64")
    total, target = int((lengths * counts).sum()), float(rows["target"].iloc[0])
    rounds = min(int(target // total), MAX_ROUNDS) if total else 0
    extra = fit_lengths(lengths, counts, round(target - rounds * total) if rounds < MAX_ROUNDS else 0)
    return pd.DataFrame(
        {"source": rows["source"], "size": lengths, "rounds": np.int64(rounds), "extra": extra,
         "source_size": np.int64(total), "target": target}
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED
) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, taken (words).

    Size counts words; null and empty texts have size 0 and take nothing. A null source is
    a source of its own, the last one. Each document is taken 0, 1 or 2 times. Ties in the
    seeded order fall to the id, and rows that repeat an id count as documents each. The
    result depends on rows and seed only. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(text_col).alias("size")
    )
    rows = written(
        rows.withColumn("draw", F.xxhash64(F.lit(seed), "doc_id")).withColumn("part", F.pmod("draw", F.lit(PARTS)).cast("int")),
        "mix-sizes",
    )
    by_part = written(rows.groupBy("source", "size", "part").agg(F.count("*").alias("n")), "mix-parts")
    by_length = by_part.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sizes = written(by_length.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), "mix-sources")
    targets = source_targets(sizes)
    wanted = by_length.join(targets, by_length["source"].eqNullSafe(targets["source"])).select(
        by_length["source"], "size", "n", "target"
    )
    fitted = wanted.groupBy("source").applyInPandas(
        _fit_source, "source string, size bigint, rounds bigint, extra bigint, source_size bigint, target double"
    )
    # Parts of a length in order; each takes what the parts before it leave of the extra documents.
    before = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = by_part.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    quota = parts.join(
        fitted, parts["source"].eqNullSafe(fitted["source"]) & (parts["size"] == fitted["size"])
    ).select(
        parts["source"].alias("q_source"), parts["size"].alias("q_size"), F.col("part").alias("q_part"),
        "rounds", "source_size", "target", (F.col("extra") - F.col("before")).alias("here"),
    )
    quota = written(quota, "mix-quota")
    order = Window.partitionBy("source", "size", "part").orderBy("draw", F.asc_nulls_last("doc_id"))
    placed = rows.withColumn("place", F.row_number().over(order))
    once_more = (F.col("place") <= F.col("here")).cast("bigint")
    return placed.join(
        quota,
        F.col("source").eqNullSafe(F.col("q_source")) & (F.col("size") == F.col("q_size")) & (F.col("part") == F.col("q_part")),
    ).select(
        "doc_id", "size", "source_size", "target", ((F.col("rounds") + once_more) * F.col("size")).alias("taken")
    )
