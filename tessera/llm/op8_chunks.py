"""Substring dedup by content-defined chunks: gear rolling hash, digests, first copy kept."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import cut, frugal, ship, small
from tessera.llm.kernels import mix, prefix_hashes, slices, span_hashes, utf8

#: The gear table: a byte's random 32-bit number.
GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
#: A boundary follows a byte where the masked hash is 0; it depends on the last 16 bytes.
MASK = np.uint32(0b1111 << 12)
LEAST, MOST = 20, 256
#: Bytes of neighbouring repeated chunks from which they are removed: shorter runs are common phrases.
RUN = 100


def gear(data: np.ndarray) -> np.ndarray:
    """The low 16 bits of the gear hash after each byte, h = (h << 1) + GEAR[byte], for all bytes at once by doubling."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        if len(h) > step:
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return h


def chunk_ends(data: np.ndarray, offsets: np.ndarray, least: int = LEAST, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """End byte of each chunk and, per text, the index of its first chunk (and the end).

    Cuts come from the 16 bytes before them, at least `least` bytes after the last cut. A text's first 16 bytes
    see zeros before them, not the text before.
    """
    marks = np.flatnonzero((gear(data) & MASK) == 0) + 1
    first = np.searchsorted(marks, offsets[:-1] + 16)  # nearer to the start a hash would see another text's bytes
    last = np.searchsorted(marks, offsets[1:])
    ends: list[int] = []
    bounds = [0]
    marks_list = marks.tolist()
    for a, b, i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), first.tolist(), last.tolist()):
        at = a
        for m in marks_list[i:j]:
            while m - at > most:
                at += most
                ends.append(at)
            if m - at >= least:
                ends.append(m)
                at = m
        while b - at > most:
            at += most
            ends.append(at)
        if at < b:
            ends.append(b)
        bounds.append(len(ends))
    return np.array(ends, np.int64), np.array(bounds, np.int64)


def chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row, start, end (in the text) and digest of each chunk, a slice of rows at a time."""
    data, offsets = utf8(column)
    for i, j in slices(offsets):
        part, cuts = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        ends, bounds = chunk_ends(part, cuts)
        if not len(ends):
            continue
        row = np.repeat(np.arange(j - i), np.diff(bounds))
        starts = np.concatenate([[0], ends[:-1]])
        starts[bounds[:-1][np.diff(bounds) > 0]] = cuts[:-1][np.diff(bounds) > 0]
        digest = span_hashes(prefix_hashes(part), starts, ends).view(np.int64)
        yield row + i, starts - cuts[row], ends - cuts[row], digest


#: Stands for a null id.
_NONE = -(1 << 63)


def again(row: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Which chunks have their digest earlier in their own text; rows ascend."""
    order = np.lexsort((np.arange(len(row)), digest, row))
    out = np.zeros(len(row), bool)
    out[order[1:]] = (row[order[1:]] == row[order[:-1]]) & (digest[order[1:]] == digest[order[:-1]])
    return out


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", run_bytes: int = RUN) -> DataFrame:
    """doc_id, n_bytes, n_chunks, n_repeated, n_removed, kept_sha256, kept of each row of docs.

    A chunk is repeated when a chunk of the same digest stands in a text of a smaller id, or earlier in its own.
    Runs of neighbouring repeated chunks of run_bytes or more are removed, so the first copy of a passage stays.
    Rows of one id are one place: each keeps the first copies. Null and empty texts have no chunks; a null id
    counts as the smallest. An insertion moves only the cuts near it. Only id_col and text_col are read.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = docs.select(F.col(id_col).cast("long").alias("i"), F.xxhash64(text).alias("x"), text.alias("t"))
    schema = pa.schema([("digest", pa.int64()), ("i", pa.int64()), ("x", pa.int64()), ("at", pa.int64())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, names = batch.column(0).fill_null(_NONE).to_numpy(), batch.column(1).to_numpy()
            for row, a, _, digest in chunks(batch.column(2)):
                new = ~again(row, digest)  # a text tells of each digest once
                row, a, digest = row[new], a[new], digest[new]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (digest, ids[row], names[row], a)], schema=schema)

    every = docs.mapInArrow(frugal(split), "digest long, i long, x long, at long")
    # Digests of more than one id, with the smallest; the sums combine before the shuffle.
    shared = every.groupBy("digest").agg(F.min("i").alias("first"), F.max("i").alias("last")).where("first <> last")
    shared = cut(shared.select("digest", "first"))
    later = every.join(small(shared), "digest").where("i > first")
    runs = later.groupBy("i", "x").agg(F.collect_set("at").alias("ats"))
    out_schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_chunks", pa.int64()), ("n_repeated", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            counts, found = np.zeros(len(batch), np.int64), [[] for _ in range(len(batch))]
            far = [set(ats) if ats else () for ats in batch.column(2).to_pylist()]
            for row, a, b, digest in chunks(batch.column(1)):
                counts += np.bincount(row, minlength=len(batch))
                for r, x, y, old in zip(row.tolist(), a.tolist(), b.tolist(), again(row, digest).tolist()):
                    if old or x in far[r]:
                        found[r].append((x, y))
            rows = []
            for n, t, spans in zip(counts.tolist(), batch.column(1), found):
                raw, gone = t.as_py().encode(), []
                for a, b in spans:
                    if gone and gone[-1][1] == a:
                        gone[-1][1] = b
                    else:
                        gone.append([a, b])
                parts, at = [], 0
                for a, b in gone:
                    if b - a >= min(run_bytes, len(raw)):
                        parts.append(raw[at:a])
                        at = b
                kept = b"".join([*parts, raw[at:]])
                rows.append((len(raw), n, len(spans), len(raw) - len(kept), hashlib.sha256(kept).hexdigest(), kept))
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(out_schema)[1:]))], schema=out_schema)

    runs = runs.withColumnsRenamed({"i": "ri", "x": "rx"})
    joined = docs.join(runs, (F.col("x") == F.col("rx")) & (F.coalesce("i", F.lit(_NONE)) == F.col("ri")), "left")
    return joined.select("i", "t", "ats").mapInArrow(frugal(apply), "doc_id long, n_bytes long, n_chunks long, n_repeated long, n_removed long, kept_sha256 string, kept binary")
