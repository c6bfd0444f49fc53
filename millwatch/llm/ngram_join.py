"""N-gram Jaccard join with signature trees.

Documents become sets of hashed word n-grams; copies of a set travel as one. Three steps, of
which none loses a link and none sees all pairs:

1. Routing. Sets are divided into size classes such that linked sets lie in one class or
   in neighbouring ones, and for a class the hash range is cut into one part more than the
   elements two linked sets can differ in. So linked sets agree on some whole part, and the
   sets that share a part are a group: only inside of groups can links exist. Parts that
   the same sets share are one group.
2. Signature trees. A set's signature is the bitmap of its tokens, as wide as the set is
   large, and its size. The signatures of a group are the leaves of a tree whose nodes hold
   the OR of the bitmaps below and the range of sizes. A dual traversal prunes node pairs
   whose greatest possible overlap is too small and pairs that are connected already; the
   leaf pairs that remain, at most one less than there are sets, are the candidates.
3. Verification. Only the texts of candidates are fetched, once a set, and compared exactly.
   Where a candidate fails, others of its group may still link. So the sets that candidates
   of such groups connect, and that links do not connect, go through trees once more, as
   families that have their texts with them: there a leaf pair is compared at once.

A group of more than BLOCK sets is cut into blocks, which meet pairwise, as signatures. A
family is cut by sets and elements; its largest component does not meet itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import arrow_map, components, join_ids, sorted_groups, without_ids, worker_cache, written

# Leaves of one tree, at most (two blocks that meet make twice as many).
BLOCK = 2048
FANOUT = 8
# Bits of a signature for each element of its set, at least.
WIDTH = 4
# Elements of the sets of one block of a family, at most (a single set may have more).
ELEMENTS = 2_000_000
# Text that one bucket of part keys comes from, and buckets at least.
BUCKET_BYTES, BUCKETS = 32_000_000, 64
CACHED_WORDS = 100_000
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _C
    h = (h ^ (h >> np.uint64(29))) * _A
    return h ^ (h >> np.uint64(32))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the text's n-word shingles; of all its words if there are fewer."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = worker_cache(("ngram_join",), _WordHashes)
    if len(hashes) > CACHED_WORDS:
        hashes.clear()
    w = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    span = min(n, len(words))
    last = len(words) - span + 1
    h = np.full(last, span, dtype=np.uint64)
    for k in range(span):
        h = mixed(h * _B + w[k : k + last])
    return np.unique(h)


class SizeClasses:
    """Size classes of the threshold num/den, and the parts of each class."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.starts = [1]

    def of(self, n: int) -> int:
        while self.starts[-1] <= n:
            self.starts.append(self.starts[-1] * self.den // self.num + 1)
        return int(np.searchsorted(self.starts, n, side="right")) - 1

    @lru_cache(maxsize=4096)  # noqa: B019  one object per task
    def n_parts(self, c: int) -> tuple[int, int]:
        """(parts, spare ones) of a class.

        One part more than the elements that two linked sets of at most the class's size
        differ in, and as many spare ones as the smaller set will hardly leave empty. So of the parts that agree
        one is not empty, unless both sets leave more than the spare ones empty.
        """
        while len(self.starts) < c + 2:
            self.starts.append(self.starts[-1] * self.den // self.num + 1)
        most, least = self.starts[c + 1] - 1, self.starts[max(0, c - 1)]
        differ = (self.den - self.num) * 2 * most // (self.den + self.num)
        if not differ:
            return 1, 0
        spare = 0
        for _ in range(4):
            empty = (differ + 1 + spare) * math.exp(-least / (differ + 1 + spare))
            spare = math.ceil(empty + 3 * math.sqrt(empty))
        return differ + 1 + spare, spare

    @lru_cache(maxsize=4096)  # noqa: B019  one object per task
    def bounds(self, c: int) -> np.ndarray:
        k, _ = self.n_parts(c)
        return np.array([(p << 64) // k for p in range(1, k)], dtype=np.uint64)

    def keys(self, values: np.ndarray) -> np.ndarray:
        """Hashes of the parts of a sorted set, in its own class and in the next one."""
        own = self.of(len(values))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(values), dtype=np.uint64)])
        out = []
        for c in (own, own + 1):
            k, spare = self.n_parts(c)
            if k == 1:  # linked sets of this size are equal, which the digest shows
                continue
            at = np.concatenate([[0], np.searchsorted(values, self.bounds(c)), [len(values)]])
            tag = np.arange(k, dtype=np.uint64) * _B + np.uint64(c * int(_A) & 0xFFFFFFFFFFFFFFFF)
            keys = mixed(mixed(sums[at[1:]] - sums[at[:-1]]) + tag)
            filled = at[1:] > at[:-1]
            # Empty parts agree everywhere and would join all documents; they are only sent
            # by a set that leaves more of them empty than there are spare ones.
            out.append(keys[filled] if len(keys) - filled.sum() <= spare else keys)
        return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def set_id(values: np.ndarray) -> int:
    """A set's name: a hash of its elements, as a signed long."""
    return xxhash.xxh3_64_intdigest(values.tobytes()) - (1 << 63)


def signature(values: np.ndarray) -> bytes:
    """The least element, by which alike sets lie near each other, and the bitmap of the set."""
    bits = 1 << max(8, (WIDTH * len(values) - 1).bit_length())
    bitmap = np.zeros(bits, dtype=bool)
    bitmap[(values & np.uint64(bits - 1)).astype(np.int64)] = True
    return values[:1].astype("<u8").tobytes() + np.packbits(bitmap).tobytes()


_ROUTED = pa.schema(
    [("bucket", pa.int32()), ("doc_id", pa.int64()), ("sid", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("parts", pa.binary())]
)
_ROUTED_DDL = "bucket int, doc_id bigint, sid bigint, n bigint, sig binary, parts binary"


def _pack(key: np.ndarray, owner: np.ndarray, sids: np.ndarray) -> bytes:
    """Keys of one bucket with their sets, some six bytes a key."""
    used, place = np.unique(owner, return_inverse=True)
    head = np.array([len(used), len(key)], dtype="<u4")
    return b"".join(x.tobytes() for x in (head, sids[used].astype("<i8"), key.astype("<u4"), place.astype("<u2")))


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    sets, keys = np.frombuffer(packed, "<u4", 2)
    at = 8 + 8 * int(sets)
    sids = np.frombuffer(packed, "<i8", int(sets), 8)
    return np.frombuffer(packed, "<u4", int(keys), at), sids[np.frombuffer(packed, "<u2", int(keys), at + 4 * int(keys))]


def _route(n: int, num: int, den: int, buckets: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = SizeClasses(num, den)
        for whole in batches:
            for first in range(0, whole.num_rows, 4000):
                batch = whole.slice(first, 4000)
                sids, sizes, sigs, fresh, keys, owners = [], [], [], {}, [], []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    values = shingles(text.as_py() or b"", n)
                    sizes.append(len(values))
                    sid = set_id(values) if doc_id is not None and len(values) else None
                    sids.append(sid)
                    sigs.append(signature(values) if sid is not None else None)
                    if sid is not None and sid not in fresh:
                        found = classes.keys(values)
                        keys.append(found)
                        owners.append(np.full(len(found), len(fresh)))
                        fresh[sid] = None
                # Documents only pass through, dealt by their place.
                place = (mixed(np.arange(len(sids), dtype=np.uint64) + np.uint64(first)) % np.uint64(buckets)).astype(np.int32)
                nothing = pa.nulls(len(sids), pa.binary())
                columns = [pa.array(place), batch.column(0), pa.array(sids, pa.int64()), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sigs, pa.binary()), nothing], schema=_ROUTED)
                if not any(map(len, keys)):
                    continue
                key, owner = np.concatenate(keys), np.concatenate(owners)
                bucket = (key >> np.uint64(32)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                key, owner, bucket = key[order] & np.uint64(0xFFFFFFFF), owner[order], bucket[order]
                names, starts = np.unique(bucket, return_index=True)
                ends = np.append(starts[1:], len(key))
                named = np.array(list(fresh), dtype=np.int64)
                packed = [_pack(key[i:j], owner[i:j], named) for i, j in zip(starts, ends, strict=True)]
                blank = [pa.nulls(len(names), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.astype(np.int32)), *blank, pa.array(packed, pa.binary())], schema=_ROUTED
                )

    return work


_SHARED = pa.schema(
    [("gid", pa.int64()), ("sid", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.binary())]
)


def _share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as they come, and per bucket the groups: sets that share a part, named by their members."""
    for _, rows in sorted_groups(batches, ["bucket"]):
        is_doc = rows["parts"].is_null()
        docs = rows.filter(is_doc)
        blank = pa.chunked_array([pa.nulls(docs.num_rows, pa.int64())])
        yield from pa.Table.from_arrays([blank, *(docs[c] for c in _SHARED.names[1:])], schema=_SHARED).to_batches()
        packed = [_unpack(p.as_py()) for p in rows["parts"].drop_null()]
        if not packed:
            continue
        key, sid = (np.concatenate(c) for c in zip(*packed, strict=True))
        order = np.lexsort((sid, key))
        key, sid = key[order], sid[order]
        again = np.append(False, (key[1:] == key[:-1]) & (sid[1:] == sid[:-1]))
        key, sid = key[~again], sid[~again]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        counts = np.diff(np.append(starts, len(key)))
        shared = counts > 1
        if not shared.any():
            continue
        sums = np.add.reduceat(mixed(sid.view(np.uint64)), starts)
        gids, firsts = np.unique(mixed(sums + counts.astype(np.uint64))[shared], return_index=True)
        at, many = starts[shared][firsts], counts[shared][firsts]
        member = np.repeat(at - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())
        gid = np.repeat(gids.view(np.int64), many)
        for i in range(0, len(gid), 100_000):
            part = slice(i, i + 100_000)
            m = len(gid[part])
            empty = [pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(gid[part]), pa.array(sid[member[part]]), *empty], schema=_SHARED)


class SignatureTree:
    """Levels of nodes over leaves; level 0 are the leaves themselves, in the order given."""

    def __init__(self, sizes: np.ndarray, bitmaps: list[bytes]):
        # Sets of a group are of nearly one size; wider bitmaps fold into narrower ones.
        width = min(map(len, bitmaps))
        folded = [np.bitwise_or.reduce(np.frombuffer(b, np.uint8).reshape(-1, width), axis=0) for b in bitmaps]
        packed = np.stack(folded).view(np.uint64)
        self.count = len(sizes)
        self.bits, self.least, self.most = [packed], [sizes], [sizes]
        # Elements beyond one per bit: at most these can hide behind the bits two sets share.
        self.slack = [sizes - np.bitwise_count(packed).sum(axis=1, dtype=np.int64)]
        while len(self.bits[-1]) > 1:
            cut = np.arange(0, len(self.bits[-1]), FANOUT)
            self.bits.append(np.bitwise_or.reduceat(self.bits[-1], cut, axis=0))
            self.least.append(np.minimum.reduceat(self.least[-1], cut))
            self.most.append(np.maximum.reduceat(self.most[-1], cut))
            self.slack.append(np.maximum.reduceat(self.slack[-1], cut))

    def possible(self, level: int, left: np.ndarray, right: np.ndarray, num: int, den: int) -> np.ndarray:
        """Whether node pairs may hold a linked pair of leaves.

        A leaf has an element of its own for each of its bits that the other node lacks,
        so an overlap is at most the shared bits plus the leaf's slack.
        """
        shared = np.bitwise_count(self.bits[level][left] & self.bits[level][right]).sum(axis=1, dtype=np.int64)
        least, most, slack = self.least[level], self.most[level], self.slack[level]
        overlap = shared + np.minimum(slack[left], slack[right])
        overlap = np.minimum(overlap, np.minimum(most[left], most[right]))
        needed = num * (least[left] + least[right])
        sizes = (den * most[left] >= num * least[right]) & (den * most[right] >= num * least[left])
        return sizes & ((num + den) * overlap >= needed)

    def children(self, level: int, node: int) -> range:
        return range(node * FANOUT, min((node + 1) * FANOUT, len(self.bits[level - 1])))

    def leaves(self, level: int, node: int) -> range:
        width = FANOUT**level
        return range(node * width, min((node + 1) * width, self.count))


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if den * len(a) < num * len(b) or not len(a):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return den * common >= num * (len(a) + len(b) - common)


def propose(
    sizes: list[int], signatures: list[bytes], component: list[int], num: int, den: int, sets: list[np.ndarray] | None = None
) -> list[tuple[int, int]]:
    """Pairs of leaves (positions) that may be linked, none of which is known to be connected otherwise.

    A pair counts as connected once it is proposed, so at most one less than leaves are. Where
    the sets are given, only pairs that are linked are proposed.
    """
    order = sorted(range(len(sizes)), key=lambda k: (sizes[k], signatures[k][:8]))
    tree = SignatureTree(np.array([sizes[k] for k in order]), [signatures[k][8:] for k in order])
    names: dict[int, int] = {}
    parent = [names.setdefault(component[k], i) for i, k in enumerate(order)]

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out: list[tuple[int, int]] = []
    stack = [(len(tree.bits) - 1, 0, 0)]
    while stack:
        level, i, j = stack.pop()
        if level == 0:
            a, b = find(i), find(j)
            if a != b and (sets is None or linked(sets[order[i]], sets[order[j]], num, den)):
                out.append((order[i], order[j]))
                parent[max(a, b)] = min(a, b)
            continue
        root = find(tree.leaves(level, i)[0])
        if all(find(x) == root for x in tree.leaves(level, i)) and all(find(x) == root for x in tree.leaves(level, j)):
            continue
        pairs = [(a, b) for a in tree.children(level, i) for b in tree.children(level, j) if i != j or a <= b]
        if level == 1:
            pairs = [(a, b) for a, b in pairs if a != b]
        if not pairs:
            continue
        left, right = np.array(pairs).T
        good = tree.possible(level - 1, left, right, num, den)
        stack += [(level - 1, a, b) for (a, b), ok in zip(reversed(pairs), good[::-1].tolist(), strict=True) if ok]
    return out


def _candidates(num: int, den: int):
    schema = pa.schema([("gid", pa.int64()), ("shard", pa.int64()), ("u", pa.int64()), ("v", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (gid, shard), rows in sorted_groups(batches, ["gid", "shard"]):
            sids = rows["sid"].to_pylist()
            for a, b in propose(rows["n"].to_pylist(), rows["sig"].to_pylist(), sids, num, den):
                out.append((gid, shard, min(sids[a], sids[b]), max(sids[a], sids[b])))
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)

    return work


def _family_links(n: int, num: int, den: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in sorted_groups(batches, ["family", "shard"]):
            sids, component = rows["sid"].to_pylist(), rows["component"].to_pylist()
            sets = [shingles(t.as_py(), n) for t in rows["text"]]
            pairs = propose([len(s) for s in sets], [signature(s) for s in sets], component, num, den, sets)
            u, v = zip(*((sids[a], sids[b]) for a, b in pairs), strict=True) if pairs else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=schema)

    return work


def _pick(n: int):
    """The texts of the sets that are asked for; rows of one id may hold others."""
    schema = pa.schema([("sid", pa.int64()), ("text", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, asked in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                text = text.as_py() or b""
                sid = set_id(shingles(text, n))
                if sid in asked:
                    out.append((sid, text))
            sids, texts = zip(*out, strict=True) if out else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(texts, pa.binary())], schema=schema)

    return work


def _compare(n: int, num: int, den: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("ok", pa.bool_())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column(2), batch.column(3), strict=True)
            ok = [linked(shingles(a.as_py(), n), shingles(b.as_py(), n), num, den) for a, b in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], schema=schema)

    return work


def ngram_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, n: int = 3, num: int = 90, den: int = 100,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id.

    Documents link when the Jaccard similarity of their sets of n-word shingles is at least
    num/den. A-Z are lower-cased; a text of fewer than n words is one shingle; null, empty
    and blank texts have none and link with nothing, not even with each other. The
    component is named by its smallest id. A row without id has no component (null) and
    links nothing. Rows that repeat an id with other texts have a component each. Other
    columns are not read; an empty table gives no rows; texts need not be valid UTF-8.
    """
    narrow = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")
    )
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    routed = arrow_map(narrow, _route(n, num, den, max(BUCKETS, size // BUCKET_BYTES)), _ROUTED_DDL)
    dealt = routed.repartition("bucket").sortWithinPartitions("bucket")
    shared = written(
        arrow_map(dealt, _share, "gid bigint, sid bigint, doc_id bigint, n bigint, sig binary"), "ngram-shared"
    )
    rows = shared.filter("gid IS NULL")
    groups = written(shared.filter("gid IS NOT NULL").select("gid", "sid").distinct(), "ngram-groups")
    links = _links(narrow, rows.filter("sid IS NOT NULL"), groups, n, num, den, block)

    sets = rows.filter("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    joined = components(links)
    # Sets of one document and without a link are their own component and need no name.
    sets = sets.join(joined, F.col("sid") == F.col("node"), "left").filter("copies > 1 OR component IS NOT NULL")
    sets = written(sets.select("sid", "rep", F.coalesce("component", "sid").alias("component")), "ngram-sets")
    names = sets.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = written(sets.join(names, "component").select("sid", "component_id"), "ngram-named")
    return join_ids(rows.select("sid", "doc_id", "n"), named, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _links(
    narrow: DataFrame, rows: DataFrame, groups: DataFrame, n: int, num: int, den: int, block: int
) -> DataFrame:
    """Verified links (u, v) that connect all that is connected."""
    asked = written(groups.select("sid").distinct(), "ngram-asked")
    leaves = join_ids(rows, asked, "sid").groupBy("sid").agg(
        F.first("n").alias("n"), F.first("sig").alias("sig"), F.min("doc_id").alias("rep")
    )
    leaves = written(leaves, "ngram-leaves")
    members = _sharded(groups, block).join(leaves.select("sid", "n", "sig"), "sid")
    dealt = members.repartition("gid", "shard").sortWithinPartitions("gid", "shard")
    found = arrow_map(dealt, _candidates(num, den), "gid bigint, shard bigint, u bigint, v bigint")
    found = written(found, "ngram-candidates")
    pairs = written(found.select("u", "v").distinct(), "ngram-pairs")
    texts = _texts(narrow, leaves, pairs.select(F.explode(F.array("u", "v")).alias("sid")).distinct(), n)
    both = pairs.join(texts.withColumnsRenamed({"sid": "u", "text": "a"}), "u").join(
        texts.withColumnsRenamed({"sid": "v", "text": "b"}), "v"
    )
    judged = arrow_map(both.select("u", "v", "a", "b"), _compare(n, num, den), "u bigint, v bigint, ok boolean")
    judged = written(judged, "ngram-judged")
    links, failed = judged.filter("ok").select("u", "v"), judged.filter("NOT ok").select("u", "v")
    unsettled = written(found.join(failed, ["u", "v"]).select("gid", "shard").distinct(), "ngram-unsettled")
    if not unsettled.limit(1).count():
        return links
    edges = found.join(unsettled, ["gid", "shard"], "left_semi").select("u", "v").distinct()
    placed = _families(components(edges), components(links), leaves, block)
    texts = _texts(narrow, leaves, placed.select("sid").distinct(), n)
    dealt = placed.join(texts, "sid").repartition("family", "shard").sortWithinPartitions("family", "shard")
    more = written(arrow_map(dealt, _family_links(n, num, den), "u bigint, v bigint"), "ngram-more")
    return links.unionByName(more)


def _families(families: DataFrame, joined: DataFrame, leaves: DataFrame, block: int) -> DataFrame:
    """(family, shard, sid, component): every two sets of a family that are not connected share a shard.

    Sets outside of a family's largest component are cut into chunks, that component into
    blocks; chunks meet chunks and blocks, blocks do not meet.
    """
    rows = families.select(F.col("node").alias("sid"), F.col("component").alias("family")).join(leaves.select("sid", "n"), "sid")
    rows = rows.join(joined.withColumnRenamed("node", "sid"), "sid", "left")
    rows = written(rows.withColumn("component", F.coalesce("component", "sid")), "ngram-families")
    sizes = rows.groupBy("family", "component").agg(F.count("*").alias("m"), F.sum("n").alias("elements"))
    core = sizes.groupBy("family").agg(
        F.max(F.struct("m", "component", "elements")).alias("core"), F.sum("m").alias("m"), F.sum("elements").alias("elements")
    )

    def parts(m, elements):
        return F.greatest(F.ceil(m / block), F.ceil(elements / ELEMENTS)).cast("int")

    core = core.filter("m > core.m").select(
        "family", F.col("core.component").alias("core"),
        parts(F.col("core.m"), F.col("core.elements")).alias("blocks"),
        parts(F.col("m") - F.col("core.m"), F.col("elements") - F.col("core.elements")).alias("chunks"),
    )
    rows = join_ids(rows, written(core, "ngram-core"), "family", "inner")
    draw = F.xxhash64("sid", F.lit(1))
    inside = rows.filter("component = core").withColumn("own", F.pmod(draw, "blocks").cast("int"))
    outside = rows.filter("component <> core").withColumn("own", F.pmod(draw, "chunks").cast("int"))
    chunk = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    block_no = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    keys = ["family", "sid", "component"]
    with_block = outside.select(*keys, "own", block_no).select(*keys, F.concat_ws("-", F.lit("b"), "own", "other").alias("shard"))
    of_block = inside.select(*keys, "own", chunk).select(*keys, F.concat_ws("-", F.lit("b"), "other", "own").alias("shard"))
    pair = F.concat_ws("-", F.lit("c"), F.least("own", "other"), F.greatest("own", "other")).alias("shard")
    with_chunk = outside.select(*keys, "own", chunk).select(*keys, pair)
    return written(with_block.unionByName(of_block).unionByName(with_chunk), "ngram-shards")


def _sharded(groups: DataFrame, block: int) -> DataFrame:
    """Groups of more than ``block`` sets cut into blocks; a shard is where two of them meet."""
    large = groups.groupBy("gid").agg(F.count("*").alias("m")).filter(F.col("m") > block)
    large = written(large.select("gid", F.ceil(F.col("m") / block).cast("int").alias("blocks")), "ngram-large")
    small = join_ids(groups, large.select("gid"), "gid", "left_anti").withColumn("shard", F.lit(0).cast("bigint"))
    cut = join_ids(groups, large, "gid", "inner").withColumn("own", F.pmod(F.xxhash64("sid"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = cut.withColumn("met", other).withColumn(
        "shard", F.least("own", "met").cast("bigint") * F.col("blocks") + F.greatest("own", "met")
    )
    return small.unionByName(met.select("gid", "sid", "shard"))


def _texts(narrow: DataFrame, leaves: DataFrame, sids: DataFrame, n: int) -> DataFrame:
    """(sid, text): the whole text of each of the sets asked for, as a stored table."""
    asked = leaves.join(sids, "sid", "left_semi").groupBy(F.col("rep").alias("doc_id")).agg(F.collect_set("sid").alias("asked"))
    asked = written(asked, "ngram-needed")
    picked = arrow_map(join_ids(narrow, asked, "doc_id", "inner").select("text", "asked"), _pick(n), "sid bigint, text binary")
    return written(picked.dropDuplicates(["sid"]), "ngram-texts")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **method) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id; rows without id stay.

    An id that several rows share stays if any of them does. All columns are kept as they are.
    """
    found = written(ngram_components(docs, id_col, text_col, **method), "ngram-found")
    kept = F.max(F.col("doc_id") == F.col("component_id"))
    dropped = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(kept.alias("kept")).filter("NOT kept")
    return without_ids(docs, written(dropped.select("doc_id"), "ngram-dropped"), id_col)
