"""Embedding near-dedup over a flat graph with robustly pruned edges.

Equal vectors are one class, of which one member is compared. Classes are dealt to clusters
that overlap: each to its nearest centres. A cluster that is too large is clustered again, so
shards stay small at any size. A task builds the graph of a shard by batched insertion (greedy
search, robust pruning, reverse edges); the adjacency lists that a class has in its shards are
united, and walked both ways (pruning leaves some of a dense group without an edge to them). Then every class is a query: a greedy search from the shard's medoid, which goes on
through all neighbours of what lies within range. What it finds is verified in doubles. A pair
that shares several shards counts in the first.

An exact check follows. Inside a shard it compares what the walk has not met. Pairs that share no
shard are compared in blocks of home cells (each class has one home among its shards): a class
goes to the blocks that hold a cell which a link could lead to, by the angle to the cell's centre
and the cell's radius. Where vectors lie in clusters most blocks are ruled out; where they do not,
the check takes all pairs. Last, recall is audited against brute force over all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import arrow_map, components, join_ids, sorted_groups, written

# Classes of one shard, at most; its matrix of links takes the square of that in bytes.
SHARD = 4096
# Classes that the centres of a cluster are fitted on, in expectation, and centres at most.
SAMPLE, CENTRES = 4096, 64
# Rounds of clustering; what is still too large then is dealt by hash.
ROUNDS = 6
DEGREE, BEAM, WIDTH, BATCH, MATES = 24, 48, 4, 256, 8
# Squared occlusion factor of robust pruning.
ALPHA = 1.2**2
# Recall that the audit asks for, its queries, and the overlap it may go up to.
RECALL, AUDIT, MOST_OVERLAP = 0.95, 256, 5
# Float32 may put a cosine this far off, and each component adds its rounding.
SLACK = 1e-4
# Numbers in the vectors of a block, in expectation; blocks whose visitors share a task.
BLOCK, VISITS = 2**20, 4
# Angles may be this far off.
ANGLE_SLACK = 1e-3
# A shard's home cell is cut into narrow ones if that many of this angle will do.
CELLS, NARROW = 16, 0.5


class FlatGraph:
    """A graph over unit vectors: rows of ``adjacent``, filled up with -1, or edges that are given."""

    def __init__(self, x: np.ndarray, edges: tuple[np.ndarray, np.ndarray] | None = None, medoid: int | None = None):
        self.x = x.astype(np.float32)
        self.medoid = int(np.argmax(self.x @ self.x.mean(axis=0))) if medoid is None else medoid
        self.edges = None
        if edges is None:
            self.adjacent = np.full((len(x), DEGREE), -1, dtype=np.int32)
            self._build()
        else:
            u, v = np.divmod(np.unique(np.append(edges[0], edges[1]) * len(x) + np.append(edges[1], edges[0])), len(x))
            self.edges = np.searchsorted(u, np.arange(len(x) + 1)), v

    def _neighbours(self, row: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.edges is None:
            near = self.adjacent[ids]
            return np.repeat(row, near.shape[1])[near.ravel() >= 0], near[near >= 0]
        starts, near = self.edges
        count = starts[ids + 1] - starts[ids]
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(row, count), near[np.repeat(starts[ids], count) + place]

    def _build(self) -> None:
        order = np.random.default_rng(len(self.x)).permutation(len(self.x))
        order = np.append(self.medoid, order[order != self.medoid])
        at = 1
        while at < len(order):
            batch = order[at : at + min(at, BATCH)]
            row, ids, _ = self.search(self.x[batch])
            # Members of one batch do not find each other yet.
            alike = self.x[batch] @ self.x[batch].T
            np.fill_diagonal(alike, -np.inf)
            mates = np.argsort(-alike, axis=1)[:, : min(MATES, len(batch) - 1)]
            row = np.append(row, np.repeat(np.arange(len(batch)), mates.shape[1]))
            self._connect(batch, row, np.append(ids, batch[mates.ravel()]))
            source = np.repeat(batch, DEGREE)
            target = self.adjacent[batch].ravel()
            self._add(target[target >= 0], source[target >= 0])
            at += len(batch)

    def _connect(self, nodes: np.ndarray, row: np.ndarray, ids: np.ndarray) -> None:
        """Give ``nodes`` their robustly pruned candidates; ``row`` says whose each candidate is."""
        off = 2 - 2 * np.einsum("pd,pd->p", self.x[nodes[row]], self.x[ids])
        order = np.lexsort((ids, off, row))
        row, ids, off = row[order], ids[order], off[order]
        first = np.append(True, (row[1:] != row[:-1]) | (ids[1:] != ids[:-1]))[: len(row)]
        row, ids, off = row[first], ids[first], off[first]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        width = int(place.max(initial=0)) + 1
        step = max(1, 4_000_000 // (width * max(width, self.x.shape[1])))
        for a in range(0, len(nodes), step):
            part = slice(*np.searchsorted(row, [a, a + step]))
            some = min(step, len(nodes) - a)
            candidates = np.full((some, width), -1, dtype=np.int32)
            away = np.full((some, width), np.inf, dtype=np.float32)
            candidates[row[part] - a, place[part]] = ids[part]
            away[row[part] - a, place[part]] = off[part]
            self.adjacent[nodes[a : a + some]] = self._pruned(candidates, away)

    def _pruned(self, candidates: np.ndarray, away: np.ndarray) -> np.ndarray:
        """The nearest candidate stays and occludes those that are much nearer to it; and so on."""
        vectors = self.x[candidates]
        between = 2 - 2 * (vectors @ vectors.transpose(0, 2, 1))
        alive = candidates >= 0
        rows = np.arange(len(candidates))
        out = np.full((len(candidates), DEGREE), -1, dtype=np.int32)
        for k in range(DEGREE):
            nearest = alive.argmax(axis=1)
            any_left = alive[rows, nearest]
            if not any_left.any():
                break
            out[any_left, k] = candidates[any_left, nearest[any_left]]
            alive &= ALPHA * between[rows, nearest] > away
            alive[rows, nearest] = False
        return out

    def _add(self, target: np.ndarray, source: np.ndarray) -> None:
        """Edges from targets to sources; lists that grow too long are pruned again."""
        new = ~(self.adjacent[target] == source[:, None]).any(axis=1)
        order = np.argsort(target[new], kind="stable")
        target, source = target[new][order], source[new][order]
        nodes, start, count = np.unique(target, return_index=True, return_counts=True)
        free = DEGREE - (self.adjacent[nodes] >= 0).sum(axis=1)
        fits = (count <= free)[np.searchsorted(nodes, target)]
        place = np.arange(len(target)) - np.repeat(start, count) + np.repeat(DEGREE - free, count)
        self.adjacent[target[fits], place[fits]] = source[fits]
        full = nodes[count > free]
        if len(full):
            held = self.adjacent[full]
            row = np.append(np.repeat(np.arange(len(full)), DEGREE)[held.ravel() >= 0], np.searchsorted(full, target[~fits]))
            self._connect(full, row, np.append(held[held >= 0], source[~fits]))

    def _unseen(self, seen: np.ndarray, row: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Neighbours of ``ids`` that their queries have not met; they are marked as met."""
        row, near = self._neighbours(row, ids)
        fresh = ~seen[row, near]
        key = np.unique(row[fresh].astype(np.int64) * len(self.x) + near[fresh])
        row, near = np.divmod(key, len(self.x))
        seen[row, near] = True
        return row, near

    def search(
        self, queries: np.ndarray, radius: float | None = None, own: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy search from the medoid: (query, node, squared distance) of the final beams.

        With ``radius``, all nodes found within it instead: the search goes on through the neighbours of
        each of them, and of the query's ``own`` node, until no new one comes.
        """
        n, some = len(self.x), len(queries)
        seen = np.zeros((some, n), dtype=bool)
        seen[:, self.medoid] = True
        row = np.arange(some)
        ids = np.full(some, self.medoid)
        off = 2 - 2 * (queries @ self.x[self.medoid])
        opened = np.zeros(some, dtype=bool)
        hits = [(row, ids, off)]
        while not opened.all():
            waiting = np.flatnonzero(~opened)
            nth = np.arange(len(waiting)) - np.searchsorted(row[waiting], row[waiting])
            chosen = waiting[nth < WIDTH]
            opened[chosen] = True
            new_row, new = self._unseen(seen, row[chosen], ids[chosen])
            new_off = 2 - 2 * np.einsum("pd,pd->p", queries[new_row], self.x[new])
            if radius is not None:
                hits.append((new_row, new, new_off))
                inside = new_off <= radius
                hits[-1] = (new_row[inside], new[inside], new_off[inside])
            row, ids, off = np.append(row, new_row), np.append(ids, new), np.append(off, new_off)
            opened = np.append(opened, np.zeros(len(new), dtype=bool))
            order = np.lexsort((off, row))
            kept = order[np.arange(len(row)) - np.searchsorted(row[order], row[order]) < BEAM]
            row, ids, off, opened = row[kept], ids[kept], off[kept], opened[kept]
        if radius is None:
            return row, ids, off
        row, ids, off = (np.concatenate(c) for c in zip(*hits, strict=True))
        inside = off <= radius
        found = [(row[inside], ids[inside], off[inside])]
        todo = [(row[inside], ids[inside])]
        if own is not None:
            seen[np.arange(some), own] = True
            todo.append((np.arange(some), own))
        while todo:
            row, ids = todo.pop()
            if len(row) > 50_000:
                todo.append((row[50_000:], ids[50_000:]))
                row, ids = row[:50_000], ids[:50_000]
            row, ids = self._unseen(seen, row, ids)
            off = 2 - 2 * np.einsum("pd,pd->p", queries[row], self.x[ids])
            inside = off <= radius
            if inside.any():
                found.append((row[inside], ids[inside], off[inside]))
                todo.append((row[inside], ids[inside]))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def unit(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as unit rows, in doubles; scaled first, so that no square overflows."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    x = np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


# Shards ------------------------------------------------------------------------------------------


def _centres(overlap: int):
    """The centres of each cluster's sample, as rows to be sent to all of its parts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard, size), rows in sorted_groups(batches, ["shard", "in_shard"]):
            x = unit(rows["v"]).astype(np.float32)
            k = min(max(4, -(-4 * overlap * size // SHARD)), CENTRES, len(x))
            centres = x[np.random.default_rng(k).choice(len(x), k, replace=False)]
            for _ in range(8):
                nearest = (x @ centres.T).argmax(axis=1)
                sums = np.zeros_like(centres)
                np.add.at(sums, nearest, x)
                norm = np.linalg.norm(sums, axis=1, keepdims=True)
                centres = np.where(norm > 0, sums / np.maximum(norm, 1e-30), centres)
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard] * k, "in_shard": [size] * k, "v": list(centres.astype(np.float64))}, schema=_CENTRES
            )

    return work


_CENTRES = pa.schema([("shard", pa.int64()), ("in_shard", pa.int64()), ("v", pa.list_(pa.float64()))])
_MEMBERS = ["shard", "node", "size", "home", "v"]


def _members_ddl(rows: DataFrame) -> str:
    """Vectors of floats stay floats, which takes half the space; all work on them is in doubles."""
    return f"shard bigint, node bigint, size bigint, home boolean, v {rows.schema['v'].dataType.simpleString()}"


def _assign(overlap: int, reach: float):
    """Each row to its nearest centres, further ones only where a link could lead there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard, _), rows in sorted_groups(batches, ["shard", "part"]):
            is_centre = np.asarray(rows["node"].is_null())
            centres = unit(rows["v"].filter(pa.array(is_centre)))
            members = rows.filter(pa.array(~is_centre))
            if not members.num_rows:
                continue
            cosine = unit(members["v"]) @ centres.T
            order = np.argsort(-cosine, axis=1)[:, :overlap]
            far = np.sqrt(np.maximum(0, 2 - 2 * np.take_along_axis(cosine, order, axis=1)))
            row, place = np.nonzero(far <= far[:, :1] + reach)
            names = np.array(
                [xxhash.xxh3_64_intdigest(f"{shard}/{c}") >> 1 for c in range(len(centres))], dtype=np.int64
            )
            taken = members.take(pa.array(row))
            home = pa.array(np.asarray(taken["home"]) & (place == 0))
            columns = [pa.array(names[order[row, place]]), *(taken[c].combine_chunks() for c in ("node", "size")), home]
            columns.append(taken["v"].combine_chunks())
            yield from pa.Table.from_arrays(columns, names=_MEMBERS).to_batches(max_chunksize=2_000)

    return work


def shards(classes: DataFrame, *, least: float, overlap: int) -> DataFrame:
    """(shard, node, size, home, v): overlapping clusters of at most SHARD classes, as a stored table.

    Vectors of different lengths never share one. A class is at home in one of its shards: that
    of the nearest centres. Two classes that could link need not share a shard.
    """
    placed = classes.select(F.size("v").cast("bigint").alias("shard"), "node", "size", F.lit(True).alias("home"), "v")
    done = []
    # Twice the distance of the farthest link: beyond, a link cannot lead.
    reach = 2 * float(np.sqrt(2 - 2 * least))
    for level in range(ROUNDS + 1):
        placed = written(placed, "vector-shards")
        large = placed.groupBy("shard").agg(F.count("*").alias("in_shard")).filter(F.col("in_shard") > SHARD)
        large = written(large, "vector-large")
        done.append(join_ids(placed, large.select("shard"), "shard", "left_anti"))
        if not large.limit(1).count():
            break
        rows = join_ids(placed, large, "shard", "inner").select("shard", "in_shard", "node", "size", "home", "v")
        draw = F.xxhash64("node", F.lit(level))
        parts = F.ceil(F.col("in_shard") / SHARD).cast("int")
        if level == ROUNDS:
            part = F.xxhash64("shard", F.pmod(draw, parts))
            done.append(rows.select(part.alias("shard"), "node", "size", "home", "v"))
            break
        sample = rows.filter(F.pmod(draw, F.ceil(F.col("in_shard") / SAMPLE)) == 0).select("shard", "in_shard", "v")
        sample = sample.repartition("shard").sortWithinPartitions("shard")
        centres = written(arrow_map(sample, _centres(overlap), "shard bigint, in_shard bigint, v array<double>"), "vector-centres")
        sent = centres.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select(
            "shard", "part", *[F.lit(None).cast("bigint").alias(c) for c in ("node", "size")],
            F.lit(False).alias("home"), F.col("v").cast(rows.schema["v"].dataType),
        )
        dealt = rows.select("shard", F.pmod(draw, parts).cast("int").alias("part"), "node", "size", "home", "v").unionByName(sent)
        dealt = dealt.repartition("shard", "part").sortWithinPartitions("shard", "part")
        placed = arrow_map(dealt, _assign(overlap, reach), _members_ddl(rows))
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole


# Graphs and search -------------------------------------------------------------------------------


_LISTS = [*_MEMBERS, "cell", "off", "centre", "medoid", "near"]
_LISTS_DDL = "cell int, off double, centre array<float>, medoid boolean, near array<bigint>"


def _graphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The adjacency list of each member in its shard's graph, its cell, and the angle to the cell's centre."""
    for _, rows in sorted_groups(batches, ["shard"]):
        x = unit(rows["v"])
        graph = FlatGraph(x)
        nodes = np.asarray(rows["node"])
        medoid = np.arange(len(nodes)) == graph.medoid
        near = [nodes[a[a >= 0]] for a in graph.adjacent]
        cell, off, centre = _cells(x, np.asarray(rows["home"]))
        columns = [*(rows[c].combine_chunks() for c in _MEMBERS), pa.array(cell), pa.array(off), pa.array(centre, pa.list_(pa.float32()))]
        columns += [pa.array(medoid), pa.array(near, pa.list_(pa.int64()))]
        yield from pa.Table.from_arrays(columns, names=_LISTS).to_batches(max_chunksize=2_000)


def _cells(x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """The cells of those at home, their angles to its centre, and the centre, which stands at one row of the cell."""
    cell, off = np.zeros(len(x), dtype=np.int32), np.zeros(len(x))
    centres: list = [None] * len(x)
    at = np.flatnonzero(home)
    if not len(at):
        return cell, off, centres
    own = x[at]
    leaders, of, best = [0], np.zeros(len(own), dtype=np.int32), own @ own[0]
    while best.min() < np.cos(NARROW) and len(leaders) < CELLS:
        leaders.append(int(best.argmin()))
        cosine = own @ own[leaders[-1]]
        of[cosine > best] = len(leaders) - 1
        best = np.maximum(best, cosine)
    middle = own[leaders]
    if best.min() < np.cos(NARROW):  # too many would be needed
        leaders, of = [0], np.zeros(len(own), dtype=np.int32)
        mean = own.mean(axis=0)
        middle = mean[None] if np.abs(mean).max() >= 1e-3 else own[:1]
    middle = (middle / np.sqrt((middle * middle).sum(axis=1, keepdims=True))).astype(np.float32)
    for k, leader in enumerate(leaders):
        centres[at[leader]] = middle[k]
    cell[at] = of
    off[at] = np.arccos(np.clip(np.einsum("nd,nd->n", own, middle[of].astype(np.float64)), -1, 1))
    return cell, off, centres


def _angles(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ centres.T, -1, 1))


def _slack(dims: int) -> float:
    return SLACK + dims * 2.0**-23


def _verified(x: np.ndarray, u: np.ndarray, v: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of rows are links, in doubles."""
    chunk = max(1, 4_000_000 // x.shape[1])
    parts = [
        np.einsum("pd,pd->p", x[u[b : b + chunk]], x[v[b : b + chunk]]) >= least for b in range(0, len(u), chunk)
    ]
    return np.concatenate([np.zeros(0, dtype=bool), *parts])


def _links(x: np.ndarray, graph: FlatGraph, least: float) -> np.ndarray:
    """Which members are linked: found by a range search of either or the check after it, then verified in doubles."""
    n = len(x)
    found = np.zeros((n, n), dtype=bool)
    step = max(1, min(BATCH, 64_000_000 // max(n, 1)))
    for a in range(0, n, step):
        own = np.arange(a, min(n, a + step))
        row, ids, _ = graph.search(graph.x[own], 2 - 2 * (least - SLACK), own)
        found[own[row], ids] = True
    found |= found.T
    for a in range(0, n, 256):
        # What the walk has not met.
        found[a : a + 256] |= graph.x[a : a + 256] @ graph.x.T >= least - _slack(x.shape[1])
    found |= found.T
    np.fill_diagonal(found, False)
    for a in range(0, n, 256):
        row, ids = np.nonzero(np.triu(found[a : a + 256], a + 1))
        row += a
        wrong = ~_verified(x, row, ids, least)
        found[row[wrong], ids[wrong]] = found[ids[wrong], row[wrong]] = False
    return found


def _range_search(least: float):
    """Per member: the weight of its links that count in this shard, and the least node that is reached."""
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard,), rows in sorted_groups(batches, ["shard"]):
            nodes, sizes = np.asarray(rows["node"]), np.asarray(rows["size"])
            order = np.argsort(nodes)
            lists = rows["near"].combine_chunks()
            ends = np.asarray(lists.offsets)
            near = np.asarray(lists.flatten())
            row = np.repeat(np.arange(len(nodes)), np.diff(ends))
            # Lists come from all shards of a member; here only nodes of this one can be visited.
            at = order[np.minimum(np.searchsorted(nodes, near, sorter=order), len(nodes) - 1)]
            here = nodes[at] == near
            x = unit(rows["v"])
            medoid = int(np.flatnonzero(np.asarray(rows["medoid"]))[0])
            found = _links(x, FlatGraph(x, (row[here], at[here]), medoid), least)
            counted = found & ~_met_before(rows["shards"].to_pylist(), shard)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(counted @ sizes), pa.array(_roots(found, nodes))], schema=schema
            )

    return work


def _met_before(lists: list[list[int]], shard: int) -> np.ndarray:
    """Whether two members also share a shard of smaller name."""
    before = [[s for s in names if s < shard] for names in lists]
    members: dict[int, list[int]] = {}
    for k, names in enumerate(before):
        for s in names:
            members.setdefault(s, []).append(k)
    met = np.zeros((len(lists), len(lists)), dtype=bool)
    for shared in members.values():
        met[np.ix_(shared, shared)] = True
    return met


def _roots(found: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The least node reachable by links, per member."""
    root = nodes.copy()
    unseen = np.ones(len(nodes), dtype=bool)
    for start in np.argsort(nodes):
        if not unseen[start]:
            continue
        unseen[start] = False
        front = np.array([start])
        while len(front):
            root[front] = nodes[start]
            front = np.flatnonzero(found[front].any(axis=0) & unseen)
            unseen[front] = False
    return root


# Pairs that share no shard ------------------------------------------------------------------------


def _visits(least: float):
    """Each row at home in a shard to the blocks with a cell that a link could lead to."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in sorted_groups(batches, ["shard"]):
            is_cell = np.asarray(rows["node"].is_null())
            members, cells = rows.filter(pa.array(~is_cell)), rows.filter(pa.array(is_cell))
            if not members.num_rows or not cells.num_rows:
                continue
            reach = np.asarray(cells["radius"]) + np.arccos(max(-1.0, min(1.0, least))) + ANGLE_SLACK
            blocks, of = np.unique(np.asarray(cells["block"]), return_inverse=True)
            near = np.zeros((members.num_rows, len(blocks)), dtype=bool)
            row, cell = np.nonzero(_angles(unit(members["v"]), unit(cells["v"])) <= reach)
            near[row, of[cell]] = True
            row, at = np.nonzero(near)
            own = np.asarray(members["own_block"])[row]
            taken = members.take(pa.array(row))
            columns = [pa.array(blocks[at]), pa.array(own // VISITS), pa.array(np.zeros(len(row), dtype=bool))]
            columns += [taken[c].combine_chunks() for c in _COMPARED]
            table = pa.Table.from_arrays(columns, names=["block", "part", "resident", *_COMPARED])
            yield from table.to_batches(max_chunksize=2_000)

    return work


_COMPARED = ["node", "size", "shards", "v"]


def _apart(names: list[list[int]]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Whether the rows of a pair share none of their ``names``."""
    held = np.zeros((len(names), max(map(len, names))), dtype=np.int64)
    filled = np.zeros(held.shape, dtype=bool)
    for k, some in enumerate(names):
        held[k, : len(some)], filled[k, : len(some)] = some, True

    def apart(u: np.ndarray, v: np.ndarray) -> np.ndarray:
        shared = np.zeros(len(u), dtype=bool)
        for i in range(held.shape[1]):
            for j in range(held.shape[1]):
                shared |= filled[u, i] & filled[v, j] & (held[u, i] == held[v, j])
        return ~shared

    return apart


def _joined(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """``label`` (each row's representative) after the rows of each pair are joined."""
    while (differ := label[u] != label[v]).any():
        u, v = u[differ], v[differ]
        a, b = label[u], label[v]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    return label


def _compare_blocks(least: float):
    """Residents of a block with its visitors, and with each other where their own part comes up.

    Per row with a link: the weight of its links that share no shard, and a node it is connected to.
    """
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (block, part), rows in sorted_groups(batches, ["block", "part"]):
            resident = np.asarray(rows["resident"])
            base = np.flatnonzero(resident)
            asking = np.arange(len(resident)) if block // VISITS == part else np.flatnonzero(~resident)
            if not len(base) or not len(asking):
                continue
            nodes, sizes = np.asarray(rows["node"]), np.asarray(rows["size"])
            x, apart = unit(rows["v"]), _apart(rows["shards"].to_pylist())
            narrow = x.astype(np.float32)
            against = narrow[base].T.copy()
            links, label = np.zeros(len(nodes), dtype=np.int64), np.arange(len(nodes))
            step = max(1, 4_000_000 // len(base))
            for a in range(0, len(asking), step):
                row, at = np.nonzero(narrow[asking[a : a + step]] @ against >= least - _slack(x.shape[1]))
                u, v = asking[a : a + step][row], base[at]
                once = ~resident[u] | (u > v)
                u, v = u[once], v[once]
                away = apart(u, v)
                u, v = u[away], v[away]
                good = _verified(x, u, v, least)
                u, v = u[good], v[good]
                np.add.at(links, u, sizes[v])
                np.add.at(links, v, sizes[u])
                label = _joined(label, u, v)
            linked = links > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[linked]), pa.array(links[linked]), pa.array(nodes[label[linked]])], schema=schema
            )

    return work


def _links_between_shards(graphs: DataFrame, least: float) -> DataFrame:
    """(node, links, root) from all pairs of classes that share no shard."""
    names = graphs.groupBy("node").agg(F.collect_set("shard").alias("shards"))
    home = graphs.filter("home").select("shard", "node", "size", "v").join(names, "node")
    home = written(home, "vector-homes")
    cells = graphs.filter("home").groupBy("shard", "cell").agg(
        F.first("centre", ignorenulls=True).alias("centre"), F.max("off").alias("radius"), F.count("*").alias("n")
    )
    cells = cells.withColumn("dims", F.size("centre").cast("bigint"))
    per_block = F.greatest(F.lit(1), F.floor(F.lit(BLOCK) / F.col("dims")))
    blocks = cells.groupBy("dims").agg(F.sum("n").alias("n")).select("dims", F.ceil(F.col("n") / per_block).alias("blocks"))
    block = F.shiftleft("dims", 32) + F.pmod(F.xxhash64("shard"), F.col("blocks"))
    cells = cells.join(blocks, "dims").select("shard", "cell", "dims", "centre", "radius", block.alias("block"))
    cells = written(cells, "vector-cells")

    # Of two blocks one visits the other; which, depends on whether their sum is odd, so that visits are spread.
    there = cells.select("dims", F.col("shard").alias("of"), "cell", F.col("centre").alias("v"), "radius", "block")
    here = cells.select("dims", "shard", "centre", F.col("radius").alias("own_radius"), F.col("block").alias("own_block"))
    visits = (F.col("own_block") < F.col("block")) != ((F.col("own_block") + F.col("block")) % 2 == 1)
    products = F.zip_with("centre", "v", lambda p, q: p.cast("double") * q.cast("double"))
    cosine = F.aggregate(products, F.lit(0.0), lambda total, e: total + e)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
    farthest = F.col("radius") + F.col("own_radius") + float(np.arccos(max(-1.0, min(1.0, least)))) + ANGLE_SLACK
    pairs = here.join(there, "dims").filter((F.col("own_block") != F.col("block")) & visits).filter(angle <= farthest)
    pairs = pairs.dropDuplicates(["shard", "of", "cell"]).select("shard", "own_block", "block", "radius", "v")
    pairs = written(pairs, "vector-cell-pairs")

    homes = cells.select("shard", "block").distinct()
    several = homes.groupBy("block").agg(F.count("*").alias("n")).filter("n > 1")
    part = lambda of: F.floor(F.col(of) / VISITS).alias("part")
    groups = pairs.select("block", part("own_block")).unionByName(several.select("block", part("block"))).distinct()
    groups = written(groups, "vector-groups")
    tasks = min(max(1, groups.count()), 20_000)

    at_home = home.join(homes.withColumnRenamed("block", "own_block"), "shard")
    null = lambda kind: F.lit(None).cast(kind)
    rows = at_home.select(
        "shard", "node", "size", "shards", "v", null("bigint").alias("block"), null("double").alias("radius"), "own_block"
    )
    sent = pairs.select(
        "shard", null("bigint").alias("node"), null("bigint").alias("size"), null("array<bigint>").alias("shards"),
        F.col("v").cast(home.schema["v"].dataType).alias("v"), "block", "radius", "own_block",
    )
    ddl = f"block bigint, part bigint, resident boolean, node bigint, size bigint, shards array<bigint>, v {home.schema['v'].dataType.simpleString()}"
    asked = rows.unionByName(sent).repartition("shard").sortWithinPartitions("shard")
    visitors = arrow_map(asked, _visits(least), ddl)
    residents = at_home.withColumnRenamed("own_block", "block").join(groups, "block")
    residents = residents.select("block", "part", F.lit(True).alias("resident"), *_COMPARED)
    dealt = visitors.unionByName(residents).repartition(tasks, "block", "part").sortWithinPartitions("block", "part")
    return arrow_map(dealt, _compare_blocks(least), "node bigint, links bigint, root bigint")


def _usable(vector: str):
    """Not null, not empty, without null or non-finite components, not zero."""
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda e: e != 0), F.lit(False))


def _judge(classes: DataFrame, least: float, overlap: int) -> DataFrame:
    """(k1, k2, n_links, component_id) per class."""
    members = shards(classes, least=least, overlap=overlap)
    dealt = members.repartition("shard").sortWithinPartitions("shard", "node")
    graphs = written(arrow_map(dealt, _graphs, f"{_members_ddl(members)}, {_LISTS_DDL}"), "vector-graphs")
    united = graphs.groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"), F.collect_set("shard").alias("shards")
    )
    ready = graphs.drop("near", "cell", "off", "centre", "home").join(united, "node").repartition("shard").sortWithinPartitions("shard", "node")
    inside = arrow_map(ready, _range_search(least), "node bigint, links bigint, root bigint")
    found = written(inside.unionByName(_links_between_shards(graphs, least)), "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    placed = classes.select("node", "k1", "k2", "rep", "size").join(counts, "node").join(joined, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    names = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    judged = placed.join(names, "component")
    return written(
        judged.select("k1", "k2", (F.col("links") + F.col("size") - 1).alias("n_links"), "component_id"), "vector-judged"
    )


def brute_counts(vectors: DataFrame, queries: list[tuple[int, list[float]]], least: float) -> dict[int, int]:
    """For each query its number of rows of ``vectors`` (column ``v``) with a cosine of at least ``least``, itself included.

    The queries stand in each task; rows of other lengths than a query's are not compared.
    """
    by_length: dict[int, list] = {}
    for key, v in queries:
        by_length.setdefault(len(v), []).append((key, v))
    known = {d: ([k for k, _ in of], unit(pa.array([v for _, v in of]))) for d, of in by_length.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, int] = {}
        for batch in batches:
            lengths = np.asarray(batch.column(0).value_lengths())
            for d, (keys, q) in known.items():
                rows = batch.column(0).filter(pa.array(lengths == d))
                for a in range(0, len(rows), 2_000):
                    near = (unit(rows.slice(a, 2_000)) @ q.T >= least).sum(axis=0)
                    for key, count in zip(keys, near.tolist(), strict=True):
                        totals[key] = totals.get(key, 0) + count
        yield pa.RecordBatch.from_pydict({"key": list(totals), "n": list(totals.values())}, pa.schema([("key", pa.int64()), ("n", pa.int64())]))

    counted = arrow_map(vectors.select("v"), work, "key bigint, n bigint").groupBy("key").agg(F.sum("n"))
    return {key: int(n) for key, n in counted.collect()}


def audited_recall(rows: DataFrame, judged: DataFrame, least: float, queries: int = AUDIT) -> float:
    """The share of the true links of some queries (those of the smallest hashes) that were found."""
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(queries).join(judged, ["k1", "k2"])
    picked = [(k, list(r["v"]), r["n_links"]) for k, r in enumerate(chosen.select("v", "n_links").collect())]
    truth = brute_counts(rows, [(k, v) for k, v, _ in picked], least)
    wanted = sum(truth.get(k, 1) - 1 for k, _, _ in picked)
    return sum(n for _, _, n in picked) / wanted if wanted else 1.0


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, least: float = 0.9, overlap: int = 2
) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept.

    Vectors link at a cosine of ``least`` or more. Vectors that are null, empty, zero or hold null
    or non-finite components link with nothing, nor do vectors of different lengths, nor rows
    without id (which have no component and are kept). Rows that repeat an id count each, by
    their own vector; equal vectors are linked. A component has the name of its smallest id,
    and that row is kept. Other columns are not read; an empty table gives no rows. All links
    are found: what the graphs miss, the check after them compares.
    """
    v = F.col(f"`{vector_col}`")
    if vectors.select(v.alias("v")).schema["v"].dataType.simpleString() != "array<float>":
        v = v.cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), v.alias("v"))
    usable = _usable("v") & F.col("vec_id").isNotNull()
    valid = rows.filter(usable).select("vec_id", "v", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2"))
    classes = valid.groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"), F.first("v").alias("v"))
    # Numbered once and stored: the numbers hold for all that follows.
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    while True:
        judged = _judge(classes, least, overlap)
        if overlap >= MOST_OVERLAP or audited_recall(valid, judged, least) >= RECALL:
            break
        overlap += 1
    named = valid.select("vec_id", "k1", "k2").join(judged, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~usable).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    whole = named.unionByName(alone)
    return whole.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
