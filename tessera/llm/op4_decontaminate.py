"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import BATCH_BYTES, frugal, ship
from tessera.llm.kernels import LETTER_DIGIT, LOWER, SLICE_BYTES, merged, slices, utf8, word_bounds, word_hashes as hashes_of

#: Words of a window that counts as contamination.
WINDOW = 10
#: Item words in one automaton; more items make more automata, which run one after another.
BLOCK_WORDS = 200_000


class Automaton:
    """A generalised suffix automaton over the words of items.

    A window is `window` consecutive words of an item, or the whole of a shorter item. Words are known by their
    64-bit hashes.
    """

    def __init__(self, items: list[tuple[object, list[int]]], window: int):
        self.window = window
        self.vocabulary = np.unique(np.array([w for _, ws in items for w in ws], np.uint64))
        number = {int(w): i for i, w in enumerate(self.vocabulary)}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(item, [number[w] for w in ws]) for item, ws in items]
        for _, ws in coded:
            last = 0
            for w in ws:
                last = self._extend(last, w)
        self.least = min([window, *(len(ws) for _, ws in coded if ws)])
        # Which items a window belongs to: kept where the window's last word ends, at the state whose class has that length.
        self.items: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, object]]] = {}
        for item, ws in coded:
            v = 0
            for n, w in enumerate(ws, 1):
                v = self.next[v][w]
                if n >= window:
                    self.items.setdefault(self._shrink(v), set()).add(item)
            if 0 < len(ws) < window:
                self.short.setdefault(v, []).append((len(ws), item))
        # Short items are found from every state below theirs: hand their lists down the suffix links, shortest first.
        if self.short:
            for v in sorted(range(1, len(self.link)), key=self.length.__getitem__):
                if up := self.short.get(self.link[v]):
                    self.short[v] = up + self.short.get(v, [])

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = len(link)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _clone(self, p: int, w: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        c = len(link)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = c
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = link[p]
        return c

    def _shrink(self, v: int) -> int:
        """The state of the last `window` words of what v stands for."""
        while self.length[self.link[v]] >= self.window:
            v = self.link[v]
        return v

    def scan(self, words: list[int]) -> tuple[list[tuple[int, int]], set]:
        """Spans of words inside occurrences of windows, and the items whose windows occur. words: numbers in the vocabulary."""
        nxt, link, length, window, short = self.next, self.link, self.length, self.window, self.short
        spans, items, v, n = [], set(), 0, 0
        for i, w in enumerate(words):
            while v and w not in nxt[v]:
                v = link[v]
                n = length[v]
            if w in nxt[v]:
                v = nxt[v][w]
                n += 1
            else:
                n = 0
            if n >= window:
                spans.append((i - n + 1, i + 1))
                items |= self.items[self._shrink(v)]
            for k, item in short.get(v, ()):
                if k <= n:
                    spans.append((i - k + 1, i + 1))
                    items.add(item)
        return spans, items


def word_hashes(texts: list[str | None]) -> list[list[int]]:
    """Hashes of the words of each text."""
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    low = LOWER[data]
    starts, ends = word_bounds(low, offsets, LETTER_DIGIT)
    h, at = hashes_of(low, starts, ends).tolist(), np.searchsorted(starts, offsets).tolist()
    return [h[a:b] for a, b in zip(at[:-1], at[1:])]


def blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int = BLOCK_WORDS) -> Iterator[list[tuple[object, list[int]]]]:
    """Items in id order, in blocks of at most `most` words (or one item): the size of each broadcast is bounded."""
    block, n = [], 0
    rows = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t is not null").orderBy("i", "t")
    for row in rows.toLocalIterator():
        words = word_hashes([row.t])[0]
        if words:
            if block and n + len(words) > most:
                yield block
                block, n = [], 0
            block.append((row.i, words))
            n += len(words)
    if block:
        yield block


class Scanner:
    """Finds windows in Arrow text columns."""

    def __init__(self, automata, slice_bytes: int = SLICE_BYTES):
        self.automata, self.slice_bytes = automata, slice_bytes

    def scan(self, column: pa.Array) -> Iterator[tuple[int, int, list[tuple[int, int]], set, np.ndarray, np.ndarray]]:
        """Per text: row, number of words, hit spans in words, items, first byte and end of each word."""
        data, offsets = utf8(column)
        for i, j in slices(offsets, self.slice_bytes):
            part, cuts = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            low = LOWER[part]
            starts, ends = word_bounds(low, cuts, LETTER_DIGIT)
            h, at = hashes_of(low, starts, ends), np.searchsorted(starts, cuts)
            spans: dict[int, list] = {}
            items: dict[int, set] = {}
            for auto in self.automata:
                words = np.minimum(np.searchsorted(auto.vocabulary, h), len(auto.vocabulary) - 1)
                known = auto.vocabulary[words] == h
                # Runs of known words inside one text; a run shorter than the shortest window cannot hold one.
                first, last = known.copy(), known.copy()
                first[1:] &= ~known[:-1]
                last[:-1] &= ~known[1:]
                inner = at[1:-1]
                inner = inner[(inner > 0) & (inner < len(h))]
                first[inner] |= known[inner]
                last[inner - 1] |= known[inner - 1]
                a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
                long = b - a >= auto.least
                for x, y in zip(a[long].tolist(), b[long].tolist()):
                    got, named = auto.scan(words[x:y].tolist())
                    if got:
                        k = int(np.searchsorted(at, x, "right")) - 1
                        base = x - int(at[k])
                        spans.setdefault(k, []).extend((p + base, q + base) for p, q in got)
                        items.setdefault(k, set()).update(named)
            for k in range(j - i):
                a, b = int(at[k]), int(at[k + 1])
                yield i + k, b - a, merged(spans[k]) if k in spans else [], items.get(k, set()), starts[a:b] - cuts[k], ends[a:b] - cuts[k]


def _scanner_maker(docs: DataFrame, benchmark: DataFrame, window: int, item_id: str, item_text: str):
    ship(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    sent = [sc.broadcast(block) for block in blocks(benchmark, item_id, item_text)]
    built: list[Automaton] = []

    def automata() -> Iterator[Automaton]:
        """The only automaton is kept; of more, one stands in memory at a time."""
        if len(sent) == 1:
            if not built:
                built.append(Automaton(sent[0].value, window))
            yield built[0]
        else:
            for block in sent:
                yield Automaton(block.value, window)

    class Again:
        def __iter__(self):
            return automata()

    # of several automata each is built anew for a slice: then a slice is a whole Arrow batch
    return lambda: Scanner(Again(), SLICE_BYTES if len(sent) == 1 else BATCH_BYTES)


_FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())])


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """How much of each document lies inside windows of benchmark items.

    Words are runs of ASCII letters (A-Z lower-cased), digits and characters beyond ASCII. Null and empty texts
    have no words and no hits. Items with the same id count once; items without an id hit, but are not counted or named; repeated document rows each give a row. Without
    items, nothing is hit. Other columns are not read. Returns doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated.
    """
    make = _scanner_maker(docs, benchmark, window, "item_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = make()
        for batch in batches:
            rows = []
            for _, n, spans, items, _, _ in scanner.scan(batch.column(1)):
                hit, items = sum(b - a for a, b in spans), items - {None}
                rows.append((n, hit, len(items), hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest(), hit > 0))
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(_FOUND)[1:]))], schema=_FOUND)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(frugal(run), "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, most_coverage: float = 0.5) -> DataFrame:
    """Documents (doc_id, text, lang, source, n_chars) without the passages that benchmark items share with them.

    Each maximal span of words inside windows is removed with the white space after it; a document of whose words
    more than most_coverage lie in such spans is dropped whole. Documents without a hit stay as they are, null and
    empty texts too; n_chars is set anew only where text was removed.
    """
    make = _scanner_maker(docs, benchmark, window, "item_id", "text")
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = make()
        for batch in batches:
            keep, text, n_chars = [], {}, {}
            column = batch.column(1)
            for row, n, spans, _, starts, ends in scanner.scan(column):
                if not spans:
                    keep.append(row)
                elif sum(b - a for a, b in spans) <= most_coverage * n:
                    raw, out, at = column[row].as_py().encode(), [], 0
                    for a, b in spans:
                        out.append(raw[at : starts[a]])
                        at = int(starts[b]) if b < n and not raw[ends[b - 1] : starts[b]].strip() else int(ends[b - 1])
                    keep.append(row)
                    text[row] = b"".join([*out, raw[at:]]).decode()
                    n_chars[row] = len(text[row])
            if keep:
                cols = [c.take(pa.array(keep)) for c in batch.columns]
                if text:
                    cols[1] = pa.array([text[r] if r in text else v for r, v in zip(keep, cols[1].to_pylist())], pa.string())
                    cols[4] = pa.array([n_chars.get(r, v) for r, v in zip(keep, cols[4].to_pylist())], pa.int64())
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)

    cols = [F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("long")]
    return docs.select(*cols).mapInArrow(frugal(run), "doc_id long, text string, lang string, source string, n_chars long")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL = f"""
with d as (
  select doc_id, {_WORDS} as w from documents
), i as (
  select item_id, {_WORDS} as w from benchmark
), iw as (
  select distinct item_id, least(len(w), 10) as k, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as p from i where len(w) > 0)
), sizes as (select distinct k from iw
), dw as (
  select doc_id, k, p, array_to_string(w[p : p + k - 1], ' ') as win
  from (select doc_id, k, w, unnest(range(1, len(w) - k + 2)) as p from d, sizes where len(w) >= k)
), hits as (
  select dw.doc_id, dw.p, dw.k, iw.item_id from dw join iw on dw.win = iw.win and dw.k = iw.k
), covered as (
  select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(p, p + k)) as pos from hits) group by doc_id
), named as (
  select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as names from (select distinct doc_id, item_id::varchar as s from hits where item_id is not null) group by doc_id
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (doc_id) left join named using (doc_id)
"""
