"""Removal of long repeated byte strings with a column-wise collection BWT.

Every 400-byte window of a text hangs on its anchor, the 150-byte string of least hash inside it, so equal windows
hang on equal anchors at equal offsets. The windows of one anchor in one text form a segment of at most 650 bytes.
Anchors that occur once are done. Segments that are equal as a whole repeat as a whole. Of the segments left, each
kept once, those of one anchor are laid side by side and their Burrows-Wheeler order is built column by column from
the right: each round inserts one symbol of every segment and updates the order of the collection's suffixes and the
column where each first differs from the one before it. A window repeats where that column lies 400 or more ahead.
The columns stand in a file that is read once, in sequence, so memory holds a few numbers a segment.

Of an anchor with very many segments, windows that reach alike far to its left form a slice; they all hold one core of
391 bytes. The slices' pieces are grouped by their cores and ordered in the same way.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import cut, frugal, ship, small
from tessera.llm.kernels import merged, mix, prefix_hashes, slices, span_hashes, utf8

_U = np.uint64
LENGTH, ANCHOR = 400, 150
#: Distinct segments of one anchor up to which they are ordered together; those of more are cut into slices first.
GROUP = 4096
#: Window starts in a slice.
SLICE = 10
#: Bytes of segments that are ordered at once.
CHUNK_BYTES = 4 << 20
#: Text names up to which a list of needed texts is broadcast; longer lists are joined.
NEEDED = 4_000_000


def sliding(x: np.ndarray, k: int, least: bool) -> np.ndarray:
    """Least (or greatest) of every k neighbours, in a few passes whatever k is."""
    n = len(x)
    if n < k:
        return x[:0]
    pick = np.minimum if least else np.maximum
    m = -(-n // k) * k
    filled = np.full(m, np.iinfo(x.dtype).max if least else np.iinfo(x.dtype).min, x.dtype)
    filled[:n] = x
    grid = filled.reshape(-1, k)
    ahead = pick.accumulate(grid, axis=1).ravel()
    behind = pick.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[: n - k + 1], ahead[k - 1 : n])


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Text number, anchor position, first and last window start, anchor hash and segment hash of each segment.

    Positions count from the text's first byte. Texts shorter than length have none.
    """
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64, np.int64))
    n = len(data)
    if n < length:
        return none
    sums = prefix_hashes(data)
    at = np.arange(n - anchor + 1)
    h = span_hashes(sums, at, at + anchor)
    k = length - anchor + 1
    low = sliding(h, k, True)
    starts = np.arange(n - length + 1)
    text = np.searchsorted(offsets, starts, "right") - 1
    ok = starts + length <= offsets[text + 1]
    starts, text = starts[ok], text[ok]
    if not len(starts):
        return none
    # Positions that are the least of some window; each window takes the first of its own least value.
    reach = np.full(len(low) + 2 * (k - 1), 0, _U)
    reach[k - 1 : k - 1 + len(low)] = low
    mins = np.flatnonzero(h == sliding(reach, k, False)[: len(h)])
    want = low[starts]
    place = np.searchsorted(mins, starts)
    todo = np.flatnonzero(h[mins[place]] != want)
    while len(todo):
        place[todo] += 1
        todo = todo[h[mins[place[todo]]] != want[todo]]
    p = mins[place]
    new = np.ones(len(starts), bool)
    new[1:] = (p[1:] != p[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    a, b, p, text = starts[first], starts[last], p[first], text[first]
    whole = mix(span_hashes(sums, a, b + length) + (p - a).astype(_U) * _U(0x9FB21C651E98DF25))
    base = offsets[text]
    return text, p - base, a - base, b - base, h[p].view(np.int64), whole.view(np.int64)


class Columns:
    """The bytes of aligned segments, column after column, in a file of their own."""

    def __init__(self, rows: list[bytes], lows: np.ndarray):
        self.width = int(max(lo + len(r) for lo, r in zip(lows.tolist(), rows))) if rows else 0
        self.count = len(rows)
        self.file = tempfile.TemporaryFile(prefix="columns-")
        step = max(1, (4 << 20) // max(1, self.width))
        table = np.memmap(self.file, np.int16, "w+", shape=(self.width, max(1, self.count))) if self.width else None
        for i in range(0, self.count, step):
            part = np.full((len(rows[i : i + step]), self.width), -1, np.int16)
            for j, r in enumerate(rows[i : i + step]):
                part[j, lows[i + j] : lows[i + j] + len(r)] = np.frombuffer(r, np.uint8)
            table[:, i : i + len(part)] = part.T
        self.table = table

    def __iter__(self) -> Iterator[tuple[int, np.ndarray]]:
        """Columns from the last to the first; -1 where a segment has no byte."""
        for c in range(self.width - 1, -1, -1):
            yield c, np.asarray(self.table[c])

    def close(self) -> None:
        del self.table
        self.file.close()


def repeated(groups: np.ndarray, rows: list[bytes], lows: np.ndarray, length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each segment the spans of its bytes that lie in a length-byte string of another segment of its group at the same offset.

    groups are ascending; lows are the segments' first columns. Per round: the segments' next symbols in suffix
    order are the new symbols of the collection's transform; a stable sort by symbol inside groups inserts them.
    """
    m = len(rows)
    spans: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    if m < 2:
        return spans
    columns = Columns(rows, lows)
    order = np.arange(m)
    apart = np.full(m, columns.width, np.int64)  # the column where a suffix first differs from the one before it
    opened = np.full(m, -1, np.int64)  # last window start of the run of repeated windows that is open
    for c, symbols in columns:
        own = symbols[order]
        by = groups[order] * 512 + own + 1
        move = np.argsort(by, kind="stable")
        key, valid = by[move], own[move] >= 0
        same = np.zeros(m, bool)
        same[1:] = (key[1:] == key[:-1]) & valid[1:]
        new = np.full(m, c, np.int64)
        pair = np.flatnonzero(same)
        if len(pair):
            ends = np.empty(2 * len(pair), np.int64)
            ends[0::2], ends[1::2] = move[pair - 1] + 1, move[pair] + 1
            new[pair] = np.minimum.reduceat(np.append(apart, 0), ends)[0::2]
        order, apart = order[move], new
        hit = apart >= c + length
        both = hit.copy()
        both[:-1] |= hit[1:]
        now = np.zeros(m, bool)
        now[order[both]] = True
        for i in np.flatnonzero(now & (opened < 0)).tolist():
            opened[i] = c
        for i in np.flatnonzero(~now & (opened >= 0)).tolist():
            spans[i].append((c + 1 - int(lows[i]), int(opened[i]) + length - int(lows[i])))
            opened[i] = -1
    for i in np.flatnonzero(opened >= 0).tolist():
        spans[i].append((0 - int(lows[i]), int(opened[i]) + length - int(lows[i])))
    columns.close()
    return [merged(s) for s in spans]


def _occurrences(texts: DataFrame) -> DataFrame:
    """anchor, seg, x (the text's name), p, a, b of every segment of every text."""
    schema = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("x", pa.int64()), ("p", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_numpy()
            data, offsets = utf8(batch.column(1))
            for i, j in slices(offsets):
                text, p, a, b, h, whole = segments(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                if len(text):
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (h, whole, names[i:j][text], p, a, b)], schema=schema)

    return texts.mapInArrow(frugal(run), "anchor long, seg long, x long, p long, a long, b long")


def _needed(texts: DataFrame, names: DataFrame) -> DataFrame:
    """Texts of the given names: by a broadcast list of bounded length, else by a join."""
    if names.count() > NEEDED:
        return texts.join(names, "x", "left_semi")
    sent = texts.sparkSession.sparkContext.broadcast(np.sort(np.array(names.toArrow().column("x"), np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(np.isin(batch.column(0).to_numpy(), sent.value)))

    return texts.mapInArrow(frugal(run), "x long, t string")


def _cut_out(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """anchor, seg, x, p, low, once, crowded, body: the bytes of the wanted segments."""
    listed = wanted.groupBy("x").agg(F.collect_list(F.struct("anchor", "seg", "p", "a", "b", "once", "crowded")).alias("s"))
    schema = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("x", pa.int64()), ("p", pa.int64()), ("low", pa.int64()), ("once", pa.bool_()), ("crowded", pa.bool_()), ("body", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            for x, t, ss in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if x in done:  # copies of a text lie in one partition
                    continue
                done.add(x)
                raw = t.as_py().encode()
                rows = [(s["anchor"], s["seg"], x, s["p"], s["a"] - s["p"], s["once"], s["crowded"], raw[s["a"] : s["b"] + LENGTH]) for s in ss.as_py()]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    found = _needed(texts, cut(listed.select("x"))).groupBy("x").agg(F.first("t").alias("t")).join(listed, "x")
    return found.select("x", "t", "s").mapInArrow(frugal(run), "anchor long, seg long, x long, p long, low long, once boolean, crowded boolean, body binary")


_SPAN = pa.schema([("x", pa.int64()), ("first", pa.int64()), ("end", pa.int64())])


def _ordered(found: DataFrame) -> DataFrame:
    """Spans of segments that stand alone, from the column-wise order of each anchor's segments."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        anchors = np.array([r[0] for r in rows], np.int64)
        groups = np.concatenate([[0], np.cumsum(anchors[1:] != anchors[:-1])])
        lows = np.array([r[3] for r in rows], np.int64) + LENGTH - ANCHOR
        out = []
        for r, spans in zip(rows, repeated(groups, [r[5] for r in rows], lows)):
            if r[4]:
                out += [(r[1], r[2] + r[3] + a, r[2] + r[3] + b) for a, b in spans]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_SPAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if size > CHUNK_BYTES and rows[-1][0] != r[0]:
                    yield from solve(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[5])
        if rows:
            yield from solve(rows)

    near = found.select("anchor", "x", "p", "low", "once", "body").repartition("anchor").sortWithinPartitions("anchor")
    return near.mapInArrow(frugal(run), "x long, first long, end long")


def pieces(body: bytes, low: int) -> Iterator[tuple[int, int, bytes]]:
    """Slice number, first window start (counted from the anchor) and bytes of each slice of a segment."""
    last = low + len(body) - LENGTH
    for j in range(-last // SLICE, -low // SLICE + 1):
        first, end = max(low, -j * SLICE - SLICE + 1), min(last, -j * SLICE)
        if first <= end:
            yield j, first, body[first - low : end - low + LENGTH]


def _sliced(found: DataFrame) -> DataFrame:
    """The pieces of crowded anchors' segments as rows of their own, under a name of anchor, slice and core instead of the anchor's."""
    schema = pa.schema([("anchor", pa.int64()), ("x", pa.int64()), ("p", pa.int64()), ("low", pa.int64()), ("once", pa.bool_()), ("body", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for anchor, x, p, low, once, body in zip(*(c.to_pylist() for c in batch.columns)):
                for j, first, piece in pieces(body, low):
                    core = piece[-j * SLICE - first : -j * SLICE - first + LENGTH - SLICE + 1]
                    name = hashlib.blake2b(core, digest_size=8, key=(anchor & (1 << 64) - 1).to_bytes(8, "little"), salt=j.to_bytes(8, "little")).digest()
                    rows.append((int.from_bytes(name, "little", signed=True), x, p, first, once, piece))
                if len(rows) > 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    crowd = found.where("crowded").select("anchor", "x", "p", "low", "once", "body")
    return crowd.mapInArrow(frugal(run), "anchor long, x long, p long, low long, once boolean, body binary")


def _named(docs: DataFrame) -> DataFrame:
    """i, x, t of each row; x names a text, by a salt under which no two texts share a name."""
    for salt in range(8):
        texts = docs.withColumn("x", F.xxhash64(F.lit(salt), "t", F.octet_length("t")))
        twice = texts.groupBy("x").agg(F.min(_sign()).alias("s"), F.max(_sign()).alias("e")).where("s <> e")
        if not twice.limit(1).count():
            return texts.select("i", "x", "t")
    raise RuntimeError("texts share names under every salt")


def _sign() -> Column:
    return F.xxhash64(F.reverse("t"), F.lit("sign"))


def repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of docs, and kept, what is left, as bytes, where asked for.

    Texts are UTF-8 bytes (null: empty). A byte goes when a 400-byte string over it also starts at another place,
    in another text or its own; strings are judged on the input. Copies of a text, and repeated rows, are texts of
    their own, so both lose what they share. Texts under 400 bytes stay whole. Equal texts are known by 128 bits, segments
    that are equal as a whole by 128 bits of anchor and segment. Only id_col and text_col are read.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = _named(docs.select(F.col(id_col).cast("long").alias("i"), text.alias("t")))
    long = texts.where(F.octet_length("t") >= LENGTH).select("x", "t")
    every = cut(_occurrences(long))

    live = every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    every = cut(every.join(live, "anchor"))
    by_seg = every.groupBy("anchor", "seg").agg(F.count("*").alias("n"), F.min(F.struct("x", "p", "a", "b")).alias("one"))
    by_seg = cut(by_seg.select("anchor", "seg", "n", "one.*"))
    whole = every.join(small(by_seg.where("n > 1").select("anchor", "seg")), ["anchor", "seg"])
    whole = whole.select("x", F.col("a").alias("first"), (F.col("b") + LENGTH).alias("end"))

    crowd = by_seg.groupBy("anchor").agg(F.count("*").alias("segs"), F.min("n").alias("least")).where("segs > 1 and least = 1")
    wanted = by_seg.join(crowd, "anchor").select("anchor", "seg", "x", "p", "a", "b", (F.col("n") == 1).alias("once"), (F.col("segs") > GROUP).alias("crowded"))
    found = cut(_cut_out(long, wanted))
    spans = whole.union(_ordered(found.where("not crowded")))
    if found.where("crowded").limit(1).count():
        spans = spans.union(_ordered(_sliced(found)))
    spans = spans.distinct().groupBy("x").agg(F.collect_list(F.struct("first", "end")).alias("spans"))

    schema = [pa.field("doc_id", pa.int64()), pa.field("n_bytes", pa.int64()), pa.field("n_removed", pa.int64()), pa.field("n_spans", pa.int64()), pa.field("kept_sha256", pa.string())]
    schema = pa.schema([*schema, pa.field("kept", pa.binary())] if kept else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, found in zip(batch.column(1), batch.column(2)):
                raw, at, parts = t.as_py().encode(), 0, []
                gone = merged([(s["first"], s["end"]) for s in found.as_py() or ()])
                for a, b in gone:
                    parts.append(raw[at:a])
                    at = b
                left = b"".join([*parts, raw[at:]])
                rows.append((len(raw), len(raw) - len(left), len(gone), hashlib.sha256(left).hexdigest(), *([left] if kept else [])))
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:]))], schema=schema)

    kinds = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * kept
    return texts.join(spans, "x", "left").select("i", "t", "spans").mapInArrow(frugal(run), kinds)
