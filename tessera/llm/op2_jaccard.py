"""Exact n-gram Jaccard join with token-combination prefixes, and the groups that its links form.

A document is its set of k-word shingles; documents with equal sets are one node. Shingles are ordered rare first.
A link needs so many common shingles that two linked sets share one in their prefixes, and more in longer ones. Rare
shingles of a prefix are indexed one by one. Where frequent ones lie in the prefix, it is extended, frequent shingles
are dealt into B classes, and pairs of one class are indexed: B + 1 common shingles put two into one class. B goes
with the set's size, so the pairs stay a fraction of the set.

A key with several nodes is not expanded into its pairs: its nodes become members of the key's hub, its least node.
Nodes that share a key share a hub, so comparing the members of each hub loses no link. A hub of bounded size is one
group. The members of a larger one are dealt into blocks, the hub itself into each; where blocks of a hub then still
lie in different components, blocks meet blocks. A group first compares small sketches of its members: how many of a
set's shingles fall into each range of hashes, which bounds from above what two sets can share. Only members for which
that leaves a partner send their sets, read again from the texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.llm.common import connected_components, cut, frugal, ship, small
from tessera.llm.kernels import NOT_SPACE, mix, shingle_sets, slices, utf8, words_of

_U = np.uint64
#: Counters of the shingle frequency sketch, and counters in one of its rows.
COUNTERS_BITS, BLOCK = 18, 4096
#: Shingles and sets of a group that one call compares, in the mean; a longer set stands with what it meets.
GROUP_ITEMS, GROUP_NODES = 1 << 19, 512
#: Holders of a shingle in a group up to which its pairs are listed; those of more are counted by a matrix product.
LISTED = 12


def sets_of(column: pa.Array, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Shingle sets of whole texts, a slice of rows at a time."""
    data, offsets = utf8(column)
    for i, j in slices(offsets):
        part, cuts = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        _, _, hashes, at = words_of(part, cuts, NOT_SPACE)
        yield i, shingle_sets(hashes, at, k)


def digest(s: np.ndarray, salt: int = 0) -> tuple[int, int]:
    """A signed 64-bit name of a set, and a second one that tells sets apart which share the first."""
    h = mix(s + _U(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    total = int(h.sum(dtype=_U)) + len(s) * 0xD6E8FEB86659FD93
    both = np.array([total & (1 << 64) - 1, int(np.bitwise_xor.reduce(h))], _U)
    return tuple(mix(both).view(np.int64).tolist())


def classes(n: int, num: int, den: int) -> tuple[int, int, int]:
    """Size class of n, and its lower bound and that of the class below: linked sets lie in one class or in neighbours."""
    c, below, low = 0, 1, 1
    while (up := max(low + 1, -(-low * den // num))) <= n:
        c, below, low = c + 1, low, up
    return c, low, below


def split_classes(low: int, num: int, den: int) -> int:
    """B for a size class: 0 (every shingle is indexed alone) for small sets, else about the number of shingles a link may miss."""
    return 0 if low < 8 else max(1, low * (den - num) // den)


def keys(s: np.ndarray, hot: np.ndarray, num: int, den: int) -> np.ndarray:
    """Index keys of a set, such that linked sets share one.

    Keys of single rare shingles are even, the others odd.
    """
    n = len(s)
    miss = n - (-(-num * n // den))  # shingles of s that a linked set may lack
    frequent = hot[(s >> _U(64 - COUNTERS_BITS)).astype(np.int64)]
    rare, often = s[~frequent], s[frequent]
    single, out = mix(rare[: miss + 1] ^ _U(0xA5A5A5A5A5A5A5A5)) & ~_U(1), []
    if len(rare) <= miss and len(often):
        c, low, below = classes(n, num, den)
        for cls, bound in ((c, low), (c - 1, below)):
            if cls < 0:
                continue
            b = split_classes(bound, num, den)
            # in a neighbour's class the partner is the smaller set, and its B holds
            part = often[: miss + 1 + b - len(rare)]
            salt = _U((cls + 1) * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1)
            if b == 0:
                out.append(mix(part + salt))
                continue
            own = (mix(part) % _U(b)).astype(np.int64)
            order = np.argsort(own, kind="stable")
            own, part = own[order], part[order]
            ends = np.searchsorted(own, own, "right")
            for step in range(1, len(part)):
                first = np.flatnonzero(np.arange(len(part)) + step < ends)
                if not len(first):
                    break
                out.append(mix(mix(part[first] + salt) + part[first + step] * _U(0x9FB21C651E98DF25)))
    odd = np.unique(np.concatenate(out)) | _U(1) if out else single[:0]
    return np.concatenate([np.unique(single), odd])


def ranges_of(s: np.ndarray) -> bytes:
    """How many items of a set fall into each of 2^b equal ranges, some 8 to 16 in the mean; 255 stands for 255 or more."""
    bits = max(4, len(s).bit_length() - 4)
    return np.minimum(np.bincount((s >> _U(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def with_partner(sizes: np.ndarray, ranges: list[bytes], num: int, den: int) -> np.ndarray:
    """Which sets may link another of the group: two sets share at most the sum of the lesser counts of each range.

    Linked sets' numbers of ranges are equal or differ by a factor of two; the finer one is then added up in pairs.
    """
    keep, levels = np.zeros(len(sizes), bool), {}
    for i, r in enumerate(ranges):
        levels.setdefault(len(r), []).append(i)

    def grid(own: list[int]) -> np.ndarray:
        counts = np.frombuffer(b"".join(ranges[i] for i in own), np.uint8).reshape(len(own), -1).astype(np.int32)
        return np.where(counts == 255, 1 << 24, counts)

    def meet(one: np.ndarray, i: int, many: np.ndarray, others: np.ndarray) -> None:
        common = np.minimum(np.minimum(one, many).sum(axis=1), np.minimum(sizes[i], sizes[others]))
        fits = den * common >= num * (sizes[i] + sizes[others] - common)
        if fits.any():
            keep[i] = True
            keep[others[fits]] = True

    for width, own in levels.items():
        counts, below = grid(own), np.array(levels.get(width // 2, []), np.int64)
        lesser = grid(below.tolist()) if len(below) else None
        numbers = np.array(own)
        for at, i in enumerate(own):
            if at + 1 < len(own):
                meet(counts[at], i, counts[at + 1 :], numbers[at + 1 :])
            if lesser is not None:
                meet(counts[at].reshape(-1, 2).sum(axis=1), i, lesser, below)
    return keep


def _first_pass(docs: DataFrame, k: int, salt: int) -> DataFrame:
    """One row for each document (i, n, node, sign, ranges) and, for each task, its part of the frequency sketch (block, counts)."""
    schema = pa.schema([("i", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("sign", pa.int64()), ("ranges", pa.binary()), ("block", pa.int32()), ("deal", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts = np.zeros(1 << COUNTERS_BITS, np.int64)
        for batch in batches:
            n, names, ranges = [], [], []
            for _, sets in sets_of(batch.column(1), k):
                n += map(len, sets)
                ranges += [ranges_of(s) if len(s) else None for s in sets]
                names += [digest(s, salt) if len(s) else (None, None) for s in sets]
                if sets:
                    counts += np.bincount((np.concatenate(sets) >> _U(64 - COUNTERS_BITS)).astype(np.int64), minlength=len(counts))
            none = pa.nulls(len(n))
            node, sign = zip(*names) if names else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(sign, pa.int64()), pa.array(ranges, pa.binary()), none.cast(pa.int32()), none.cast(pa.int32()), none.cast(pa.binary())], schema=schema)
        parts = counts.reshape(-1, BLOCK)
        some = [j for j, c in enumerate(parts) if c.any()]
        none, deal = pa.nulls(len(some)).cast(pa.int64()), TaskContext.get().partitionId() % 64
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.nulls(len(some), pa.binary()), pa.array(some, pa.int32()), pa.array([deal] * len(some), pa.int32()), pa.array([_pack(parts[j]) for j in some], pa.binary())], schema=schema)

    return docs.mapInArrow(frugal(run), "i long, n long, node long, sign long, ranges binary, block int, deal int, counts binary")


def _pack(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _add(df: DataFrame, *by: str) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        total = np.sum([_unpack(c) for c in table.column("counts").to_pylist()], axis=0, dtype=np.int64)
        return pa.table({**{c: table.column(c)[:1] for c in by}, "counts": pa.array([_pack(total)], pa.binary())})

    return df.select(*by, "counts").groupBy(*by).applyInArrow(run, ", ".join(f"{c} int" for c in by) + ", counts binary")


def frequent_counters(first: DataFrame) -> np.ndarray:
    """Which counters of the sketch stand out: bounded, whatever the input. It only steers the order of shingles."""
    parts = _add(_add(first.where("block is not null"), "block", "deal"), "block").collect()
    counts = np.zeros(1 << COUNTERS_BITS, np.int64)
    for r in parts:
        counts[r.block * BLOCK : (r.block + 1) * BLOCK] = _unpack(r.counts)
    mean = counts.mean()
    return counts > mean + 64 + 8 * np.sqrt(mean)


def _index(docs: DataFrame, hot: np.ndarray, k: int, num: int, den: int, salt: int) -> DataFrame:
    """key, node: the index entries of every document; a task tells each node once."""
    sent = docs.sparkSession.sparkContext.broadcast(hot)
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, done = sent.value, set()
        for batch in batches:
            for _, sets in sets_of(batch.column(1), k):
                found, nodes = [], []
                for s in sets:
                    if len(s) and (d := digest(s, salt)[0]) not in done:
                        done.add(d)
                        found.append(keys(s, hot, num, den))
                        nodes.append(d)
                if found:
                    cols = np.concatenate(found).view(np.int64), np.repeat(np.array(nodes, np.int64), list(map(len, found)))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=schema)

    return docs.mapInArrow(frugal(run), "key long, node long")


def _sets(docs: DataFrame, k: int, width: int, salt: int) -> DataFrame:
    """node, items: packed sets, of each shingle the first width bytes in ascending order. A task tells each node once."""
    schema = pa.schema([("node", pa.int64()), ("items", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in batches:
            for _, sets in sets_of(batch.column(1), k):
                nodes, packed = [], []
                for s in sets:
                    if len(s) and (d := digest(s, salt)[0]) not in done:
                        done.add(d)
                        nodes.append(d)
                        packed.append(s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes())
                if nodes:
                    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(packed, pa.binary())], schema=schema)

    return docs.mapInArrow(frugal(run), "node long, items binary")


def unpacked(packed: bytes | memoryview, width: int) -> np.ndarray:
    """Distinct numbers for the items of a packed set: equal short forms are told apart by their rank."""
    raw = np.frombuffer(packed, np.uint8).reshape(-1, width)
    if width == 8:
        return raw.reshape(-1).view(">u8").astype(_U)
    x = np.zeros((len(raw), 4), np.uint8)
    x[:, 1:] = raw
    x = x.reshape(-1).view(">u4").astype(_U)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(x)), 0))
    return x << _U(24) | (np.arange(len(x)) - first).astype(_U)


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many items every two of the sets share, as a matrix; the diagonal is not filled."""
    m = len(sets)
    items, owner = np.concatenate(sets), np.repeat(np.arange(m), list(map(len, sets)))
    order = np.argsort(items, kind="stable")
    items, owner = items[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]]))
    holders = np.diff(np.append(first, len(items)))
    counts = np.zeros(m * m, np.int64)
    few = np.repeat((holders > 1) & (holders <= LISTED), holders)
    x, o = items[few], owner[few]
    for step in range(1, LISTED):
        same = np.flatnonzero(x[step:] == x[:-step])
        if not len(same):
            break
        counts += np.bincount(o[same] * m + o[same + step], minlength=m * m)
    counts = counts.reshape(m, m)
    many = np.flatnonzero(holders > LISTED)
    for a in range(0, len(many), 2048):
        part = many[a : a + 2048]
        grid = np.zeros((m, len(part)), np.float32)
        at = np.repeat(first[part], holders[part]) + _ramp(holders[part])
        grid[owner[at], np.repeat(np.arange(len(part)), holders[part])] = 1
        counts += (grid @ grid.T).astype(np.int64)
    return np.maximum(counts, counts.T)


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. size - 1 for each size, in a row."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def compared(nodes: list[int], sets: list[np.ndarray], num: int, den: int, width: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Of one group: links that connect what its links connect, and the members of pairs that whole shingles must decide.

    Three bytes of a shingle count every common one and some by chance, n * m / 2^24 in the mean. Where chance could tip
    the scale and no other links join the pair, it is left to be decided.
    """
    m, n = len(nodes), np.array(list(map(len, sets)), np.int64)
    most = common_counts(sets)
    both = n[:, None] + n[None, :]
    chance = n[:, None] * n[None, :] / (1 << 24) if width < 8 else np.zeros((m, m))
    least = np.maximum(0, most - (chance + 8 * np.sqrt(chance) + 6).astype(np.int64)) if width < 8 else most
    above = np.triu(np.ones((m, m), bool), 1)
    may, sure = ((den * c >= num * (both - c)) & above for c in (most, least))
    i, j = np.nonzero(sure)
    label = np.arange(m)
    while len(i):
        new = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = np.minimum(new, new[new])[label]
        if (new == label).all():
            break
        label = new
    links = [(nodes[label[v]], nodes[v]) for v in np.flatnonzero(label != np.arange(m)).tolist()]
    i, j = np.nonzero(may & ~sure & (label[:, None] != label[None, :]))
    return links, [nodes[v] for v in np.union1d(i, j).tolist()]


def _by_group(batches: Iterator[pa.RecordBatch], solve) -> Iterator[pa.RecordBatch]:
    """solve(group, nodes, values) of each run of rows g, h, node, value; of equal nodes one counts."""
    at, nodes, values = None, [], []
    for batch in batches:
        for g, h, node, value in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3)):
            if (g, h) != at:
                yield from solve(at, nodes, values)
                at, nodes, values = (g, h), [], []
            if not nodes or node != nodes[-1]:  # copies of a node come from several tasks
                nodes.append(node)
                values.append(value)
    yield from solve(at, nodes, values)


def _hopeful(dealt: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """g, h, node of the members that may have a partner in their group, by their sketches."""
    schema = pa.schema([("g", pa.int64()), ("h", pa.int64()), ("node", pa.int64())])

    def solve(at, nodes: list[int], values: list) -> Iterator[pa.RecordBatch]:
        if len(nodes) > 1:
            kept = with_partner(np.array([v["n"].as_py() for v in values]), [v["ranges"].as_py() for v in values], num, den)
            own = np.array(nodes, np.int64)[kept]
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), at[0])), pa.array(np.full(len(own), at[1])), pa.array(own)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_group(batches, solve)

    full = dealt.join(nodes, "node").select("g", "h", "node", F.struct("n", "ranges").alias("v"))
    return full.repartition("g", "h").sortWithinPartitions("g", "h", "node").mapInArrow(frugal(run), "g long, h long, node long")


def _solved(near: DataFrame, sets: DataFrame, num: int, den: int, width: int) -> DataFrame:
    """a, b of the links of every group, and, where b is null, the members a of group g, h that whole shingles must decide.

    near: g, h, node (a group is known by g and h). A group of m members makes less than 2 * m rows, however many of its
    pairs are open.
    """
    schema = pa.schema([("g", pa.int64()), ("h", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def solve(at, nodes: list[int], packed: list) -> Iterator[pa.RecordBatch]:
        if len(nodes) > 1:
            links, open_ = compared(nodes, [unpacked(p.as_buffer(), width) for p in packed], num, den, width)
            if rows := [(*at, a, b) for a, b in links] + [(*at, a, None) for a in open_]:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_group(batches, solve)

    own = sets.join(small(cut(near.select("node").distinct())), "node")
    full = near.join(own, "node").select("g", "h", "node", "items")
    return full.repartition("g", "h").sortWithinPartitions("g", "h", "node").mapInArrow(frugal(run), "g long, h long, a long, b long")


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of docs.

    Two documents link when den * |common shingles| >= num * |shingles of either|. Words are what lies between
    white space, A-Z lower-cased; fewer than k words are one shingle, and no words (null, empty or blank texts)
    make an empty set, which links with nothing. component_id is the smallest id that links reach, itself
    included. Repeated rows are documents that link. No link is lost: every key is followed to its end.
    Shingles are known by 64-bit hashes, sets by 128 bits. Only id_col and text_col are read.
    """
    out, _ = _grouped(docs, id_col, text_col, k, num, den)
    return out.select(F.col("i").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "i").alias("component_id"))


def _named(docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame, int]:
    """The first pass, its nodes (node, n, ranges, least id), and the salt under which no two sets share a name."""
    for salt in range(8):
        first = cut(_first_pass(docs, k, salt))
        nodes = first.where("node is not null").groupBy("node").agg(F.min("i").alias("least"), F.first("n").alias("n"), F.first("ranges").alias("ranges"), F.min("sign").alias("s"), F.max("sign").alias("t"))
        nodes = cut(nodes)
        if not nodes.where("s <> t").limit(1).count():
            return first, nodes.drop("s", "t"), salt
    raise RuntimeError("sets share names under every salt")


def _grouped(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int) -> tuple[DataFrame, int]:
    """i, n, node of each row of docs, with the node's component and its smallest id; these are null for empty sets. And the nodes' salt."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    first, nodes, salt = _named(docs, k)
    label = _components(docs, nodes, _index(docs, frequent_counters(first), k, num, den, salt), k, num, den, salt)

    joined = nodes.select("node", "least").join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    best = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = joined.join(best, "component").select("node", "component", "component_id")
    return first.where("block is null").select("i", "n", "node").join(of_node, "node", "left"), salt


def _components(docs: DataFrame, nodes: DataFrame, index: DataFrame, k: int, num: int, den: int, salt: int) -> DataFrame:
    """node, component of nodes with links."""
    # Keys with more than one node; these sums combine before the shuffle.
    live = index.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub <> last").select("key", "hub")
    stars = cut(index.join(live, "key").where("node <> hub").select("hub", "node").distinct())
    parts = F.ceil(F.greatest(F.sum("n") / GROUP_ITEMS, F.count("*") / GROUP_NODES)).alias("parts")
    sizes = cut(stars.join(nodes.select("node", "n"), "node").groupBy("hub").agg(parts))
    dealt = stars.join(small(sizes), "hub").select(F.col("hub").alias("g"), F.pmod(F.xxhash64("node", "hub"), F.col("parts")).alias("h"), "node")
    dealt = dealt.union(sizes.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)), "hub"))
    nodes = nodes.select("node", "n", "ranges")
    found = cut(_solved(cut(_hopeful(dealt, nodes, num, den)), _sets(docs, k, 3, salt), num, den, 3))
    label = cut(connected_components(found.where("b is not null").select("a", "b")))

    more = [found]
    large = sizes.where("parts > 1").select("hub")
    if large.limit(1).count():
        members = stars.join(small(cut(large)), "hub").union(large.select("hub", "hub")).join(nodes.select("node", "n"), "node")
        again = cut(_across(members, label))
        again = cut(_solved(cut(_hopeful(again, nodes, num, den)), _sets(docs, k, 3, salt), num, den, 3))
        more.append(again.withColumn("h", -1 - F.col("h")))  # not the groups of the first round
    links = [d.where("b is not null").select("a", "b") for d in more]
    open_ = cut(_apart(reduce(DataFrame.union, (d.where("b is null") for d in more)).select("g", "h", F.col("a").alias("node")), label))
    if open_.limit(1).count():
        links.append(_solved(open_, _sets(docs, k, 8, salt), num, den, 8).select("a", "b"))
    elif len(more) == 1:
        return label
    known = label.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected_components(reduce(DataFrame.union, [known, *links[1:]]))


def _apart(members: DataFrame, label: DataFrame) -> DataFrame:
    """The groups' members, of groups that do not lie in one component so far."""
    own = members.join(label, "node", "left").select("g", "h", "node", F.coalesce("component", "node").alias("c"))
    apart = own.groupBy("g", "h").agg(F.min("c").alias("c"), F.max("c").alias("last")).where("c <> last").select("g", "h")
    return own.join(small(cut(apart)), ["g", "h"]).select("g", "h", "node")


def _across(members: DataFrame, label: DataFrame) -> DataFrame:
    """g, h, node: groups in which the members of large hubs meet that are not in one component yet.

    Of a hub's members those of its largest component need to meet only the others; the others meet all.
    """
    own = members.join(label, "node", "left").select("hub", "node", "n", F.coalesce("component", "node").alias("c"))
    by = own.groupBy("hub", "c").agg(F.count("*").alias("count"), F.sum("n").alias("items"))
    sums = by.groupBy("hub").agg(F.max(F.struct("count", "c", "items")).alias("main"), F.sum("count").alias("count"), F.sum("items").alias("items")).where("main.count < count")
    blocks = lambda items, count: F.ceil(F.greatest(items / GROUP_ITEMS, count / GROUP_NODES))
    sums = sums.select("hub", F.col("main.c").alias("main"), blocks(F.col("main.items"), F.col("main.count")).alias("mains"), blocks(F.col("items") - F.col("main.items"), F.col("count") - F.col("main.count")).alias("others"))
    own = own.join(small(cut(sums)), "hub")
    is_main = F.col("c") == F.col("main")
    block = F.pmod(F.xxhash64("node", "hub"), F.when(is_main, F.col("mains")).otherwise(F.col("others")))
    own = own.select("hub", "node", "mains", "others", is_main.alias("is_main"), block.alias("b"))
    # pairs of blocks: (p, q) of others with p <= q, and (p, others + q) of others with mains
    to = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    width = F.col("mains") + F.col("others")
    with_others = F.transform(to("others"), lambda k: F.least(k, F.col("b")) * width + F.greatest(k, F.col("b")))
    with_mains = F.transform(to("mains"), lambda k: F.col("b") * width + F.col("others") + k)
    for_main = F.transform(to("others"), lambda k: k * width + F.col("others") + F.col("b"))
    return own.select(F.col("hub").alias("g"), F.explode(F.when(F.col("is_main"), for_main).otherwise(F.concat(with_others, with_mains))).alias("h"), "node")


def _with_node(docs: DataFrame, k: int, salt: int) -> DataFrame:
    """docs with __node, the name of each row's set of shingles; null for empty sets."""
    at, names = docs.columns.index("text"), [*docs.columns, "__node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [digest(s, salt)[0] if len(s) else None for _, sets in sets_of(batch.column(at), k) for s in sets]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.int64())], names=names)

    return docs.mapInArrow(frugal(run), StructType([*docs.schema.fields, StructField("__node", LongType())]))


def one_of_each(docs: DataFrame, *, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each group of rows that links reach: of the smallest id, then of the smallest text.

    Rows without an id and rows without words stay as they are. A row goes for its own text only: other texts under
    its id stay.
    """
    found, salt = _grouped(docs, "doc_id", "text", k, num, den)
    found = cut(found.where("i is not null"))
    gone = cut(found.where("i <> component_id").select(F.col("i").alias("__gone")).distinct())
    twice = cut(found.groupBy("i").agg(F.count("*").alias("rows")).where("rows > 1").select(F.col("i").alias("__twice")))
    if not twice.limit(1).count():
        return docs.join(small(gone), F.col("doc_id") == F.col("__gone"), "left_anti")
    # ids of several rows: their rows are told apart by their sets
    single = docs.join(small(twice), F.col("doc_id") == F.col("__twice"), "left_anti").join(small(gone), F.col("doc_id") == F.col("__gone"), "left_anti")
    several = _with_node(docs.join(small(twice), F.col("doc_id") == F.col("__twice"), "left_semi"), k, salt)
    leads = found.where("i = component_id").join(small(twice), F.col("i") == F.col("__twice"), "left_semi").select(F.col("node").alias("__n"), F.col("i").alias("__i"), F.col("component").alias("__component")).distinct()
    first = F.struct("text", *(c for c in docs.columns if c != "text"))
    once = several.join(small(cut(leads)), F.expr("__node = __n and doc_id = __i")).groupBy("__component").agg(F.min(first).alias("__r"))
    return single.unionByName(once.select("__r.*")).unionByName(several.where("__node is null").drop("__node"))


_SETS = r"""
w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[p : p + 3], ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as p from w where len(w) > 0)),
sizes as (select doc_id, count(*) as n from s group by doc_id)"""

ORACLE_SQL = f"""
with recursive {_SETS},
links as (
  select x.doc_id as a, y.doc_id as b from s x join s y on x.g = y.g and x.doc_id <> y.doc_id
  join sizes p on p.doc_id = x.doc_id join sizes q on q.doc_id = y.doc_id
  where p.n * 100 >= q.n * 85 and q.n * 100 >= p.n * 85
  group by x.doc_id, y.doc_id, p.n, q.n having 100 * count(*) >= 85 * (p.n + q.n - count(*))
),
reach(doc_id, other) as (select doc_id, doc_id from w union select r.doc_id, l.b from reach r join links l on r.other = l.a)
select w.doc_id, coalesce(sizes.n, 0)::bigint as n_shingles, min(reach.other)::bigint as component_id
from w join reach using (doc_id) left join sizes using (doc_id) group by w.doc_id, sizes.n
"""
