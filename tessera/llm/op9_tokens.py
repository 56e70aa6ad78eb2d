"""Token-id shards with a minimal perfect hash index for keyed access.

A shard file, all numbers little-endian:

    magic   8 bytes  b"TESSTOK1"
    ids     n_ids unsigned ids of `width` bytes, text after text
    rows    n_rows + 1 int64 offsets into ids, n_rows int64 keys, n_rows uint8 (1: the key is null)
    index   n_buckets int32 displacements, n_keys uint32 rows, n_keys uint32 fingerprints
    footer  six int64: width, n_ids, n_rows, n_keys, n_buckets, seed; then the magic again

A key's bucket gives a displacement, the displaced hash its slot, the slot a row and a fingerprint: two small
reads and one for the ids, whatever the shard's size. Keys that are not stored are told by range and fingerprint
and, last, by the key in the row.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import frugal, scratch, ship
from tessera.llm.kernels import mix, word_hashes

MAGIC = b"TESSTOK1"
END_ID = 2
_U = np.uint64


# ---------------------------------------------------------------- encoding


#: Code points whose lower case stands alone and which composition leaves as they are.
_PLAIN = [9, 10, 11, 12, 13, *(c for c in (*range(0x20, 0x7F), *range(0xA1, 0x180), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC) if c not in (0x130, 0x149, 0xAD))]
#: What a plain code point is to the pattern.
_SPACE, _LETTER, _NUMBER, _OTHER, _ODD = range(5)
_KIND = np.full(0x2100, _ODD, np.uint8)
_LOW = np.arange(0x2100, dtype=np.uint32)
for _c in _PLAIN:
    _KIND[_c] = _SPACE if chr(_c).isspace() else {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(_c).lower())[0], _OTHER)
    _LOW[_c] = ord(chr(_c).lower())

#: What the file must say for the short way to hold: the steps before the merges.
_STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pattern": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}


def pattern_words(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of each match of the pattern above in lower-cased plain code points; the last one is white space."""
    kind = _KIND[points]
    before = np.concatenate([[_SPACE], kind[:-1]])
    starts = np.flatnonzero((kind != _SPACE) & ((kind != before) | (kind == _NUMBER)))
    after = np.concatenate([kind[1:], [_SPACE]])
    ends = np.flatnonzero((kind != _SPACE) & ((kind != after) | (kind == _NUMBER))) + 1
    # an apostrophe alone before one of these endings is one word with it
    marks = np.flatnonzero((points[:-1] == ord("'")) & (before[:-1] != _OTHER) & (kind[1:] == _LETTER))
    if len(marks):
        x, y = points[marks + 1], points[np.minimum(marks + 2, len(points) - 1)]
        one = np.isin(x, [ord(c) for c in "stmd"])
        two = np.zeros(len(marks), bool)
        for u, v in ("re", "ve", "ll"):
            two |= (x == ord(u)) & (y == ord(v))
        marks, grown = marks[one | two], np.where(one, 1, 2)[one | two]
        at = np.searchsorted(starts, marks)
        ends[at] += grown
        starts[at + 1] += grown
        some = starts < ends
        starts, ends = starts[some], ends[some]
    return starts, ends


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte: itself where it prints, else the next from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)} | {0x20: " "}


class Encoder:
    """A tokenizers file's ids of whole texts, as packed little-endian unsigned numbers.

    Where the file splits lower-cased text into words by a known pattern before merging, a slice of texts is split at
    once and each of its distinct words is merged once; the ids of words met lately are kept, by two 64-bit hashes.
    Texts with characters outside a plain set, or with the strings of special tokens, take the library's own way. Files
    of another make take that way always.
    """

    WORDS_KEPT, SLICE = 400_000, 1 << 20

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.own = Tokenizer.from_file(path)
        self.width = 2 if self.own.get_vocab_size(True) <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        said = json.loads(open(path, encoding="utf-8").read())
        split = ((said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        suffix = said["model"].get("end_of_word_suffix")
        self.by_word = (
            said.get("normalizer") == _STEPS["normalizer"]
            and (split.get("pattern") or {}).get("Regex") == _STEPS["pattern"]
            and split.get("behavior") == "Removed"
            and split.get("invert") is True
            and said["pre_tokenizer"]["pretokenizers"][1:] == [{"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
            and said["model"].get("type") == "BPE"
            and bool(suffix)
            and not said.get("truncation")
            and not said.get("padding")
        )
        self.marks = [t["content"] for t in said.get("added_tokens", [])]
        if self.by_word:
            self.merger = Tokenizer(self.own.model)
            self.merger.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.letters = str.maketrans(_byte_letters())
            vocabulary = self.own.get_vocab(True)
            self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
            self.is_end[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        #: Of kept words, in the order of their hash: hash, second hash, first of their ids in pool, number of ids, and the last slice that had them.
        self.hash, self.other, self.first, self.size, self.seen = (np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
        self.pool, self.turn = np.zeros(0, self.kind), 0

    def pack(self, ids: list[int]) -> bytes:
        return np.asarray(ids, self.kind).tobytes()

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        at = 0
        while at < len(texts):
            end, chars = at + 1, len(texts[at])
            while end < len(texts) and chars + len(texts[end]) <= self.SLICE:
                chars += len(texts[end])
                end += 1
            yield from self._slice(texts[at:end])
            at = end

    def _library(self, text: str) -> bytes:
        return self.pack(self.own.encode(text, add_special_tokens=False).ids)

    def _slice(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return list(map(self._library, texts))
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
        odd = np.flatnonzero((points >= len(_KIND)) | (_KIND[np.minimum(points, len(_KIND) - 1)] == _ODD))
        apart = set((np.searchsorted(bounds, odd, "right") - 1).tolist())
        for mark in self.marks:
            if mark in joined:
                apart |= {i for i, t in enumerate(texts) if mark in t}
        if apart:
            rest = iter(self._slice([t for i, t in enumerate(texts) if i not in apart]) if len(apart) < len(texts) else ())
            return [self._library(t) if i in apart else next(rest) for i, t in enumerate(texts)]
        low = _LOW[points]
        starts, ends = pattern_words(low)
        if not len(starts):
            return [b""] * len(texts)
        short = low.astype("<u2").view(np.uint8)
        h, other = (word_hashes(short, 2 * starts, 2 * ends, seed) for seed in (0, 0x51ED270B))
        known, first, which = np.unique(h, return_index=True, return_inverse=True)
        if (other != other[first][which]).any() or not self._learn(low, known, other[first], starts[first], ends[first]):
            return list(map(self._library, texts))  # two words share a hash
        row = np.searchsorted(self.hash, known)
        self.seen[row] = self.turn
        begin, size = self.first[row][which], self.size[row][which]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.repeat(begin - total[:-1], size) + np.arange(total[-1])]
        cuts = total[np.searchsorted(starts, bounds)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]

    def _learn(self, low: np.ndarray, known: np.ndarray, other: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bool:
        """Merges the words that are not kept; false where one shares its hash with another."""
        self.turn += 1
        if len(self.hash) > self.WORDS_KEPT:
            self._age()
        row = np.minimum(np.searchsorted(self.hash, known), max(0, len(self.hash) - 1))
        met = self.hash[row] == known if len(self.hash) else np.zeros(len(known), bool)
        if (self.other[row[met]] != other[met]).any():
            return False
        new = np.flatnonzero(~met)
        if len(new):
            text = low.astype("<u4").tobytes().decode("utf-32-le")
            words = [text[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            lines = [" ".join(words[i : i + 4096]).encode().decode("latin-1").translate(self.letters) for i in range(0, len(words), 4096)]
            ids = np.concatenate([np.array(e.ids, self.kind) for e in self.merger.encode_batch_fast(lines, add_special_tokens=False)])
            last = np.flatnonzero(self.is_end[ids]) + 1
            if len(last) != len(words) or last[-1] != len(ids):
                raise ValueError("the tokenizer's words do not end where they should")
            at = np.searchsorted(self.hash, known[new])
            begin = np.concatenate([[0], last[:-1]])
            for name, own in (("hash", known[new]), ("other", other[new]), ("first", begin + len(self.pool)), ("size", last - begin), ("seen", np.full(len(new), self.turn))):
                setattr(self, name, np.insert(getattr(self, name), at, own))
            self.pool = np.concatenate([self.pool, ids])
        return True

    def _age(self) -> None:
        """Keeps the half of the words that was met last."""
        keep = np.sort(np.argsort(-self.seen, kind="stable")[: self.WORDS_KEPT // 2])
        self.hash, self.other, self.first, self.size, self.seen = (x[keep] for x in (self.hash, self.other, self.first, self.size, self.seen))
        total = np.concatenate([[0], np.cumsum(self.size)])
        self.pool = self.pool[np.repeat(self.first - total[:-1], self.size) + np.arange(total[-1])]
        self.first = total[:-1]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# ---------------------------------------------------------------- the index


def _hashes(keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    a = mix(keys.astype(np.int64).view(_U) + _U(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return a, mix(a ^ _U(0xA0761D6478BD642F))


def _slot(h: np.ndarray, shift: np.ndarray | int, n: int) -> np.ndarray:
    return mix(h + np.asarray(shift).astype(_U) * _U(0xE7037ED1A0B428DB)) % _U(n)


def build_index(keys: np.ndarray, per_bucket: int = 4, most_tries: int = 1 << 14) -> tuple[int, np.ndarray, np.ndarray]:
    """A minimal perfect hash of distinct int64 keys by hash and displace.

    Returns its seed, each bucket's displacement and each slot's key number. Buckets go from the fullest on: each
    tries displacements until its keys fall into free slots. Buckets of one key take the slots left, which their
    displacement names as -slot - 1.
    """
    n = len(keys)
    buckets = max(1, -(-n // per_bucket))
    for seed in range(1, 1000):
        shifts, slots = np.zeros(buckets, np.int32), np.full(n, -1, np.int64)
        if n == 0:
            return seed, shifts, slots
        bucket, h = _hashes(keys, seed)
        bucket = (bucket % _U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=buckets)
        firsts = np.concatenate([[0], np.cumsum(sizes)])
        done = True
        for b in np.argsort(-sizes, kind="stable").tolist():
            size = int(sizes[b])
            if size < 2:
                break
            own = order[firsts[b] : firsts[b] + size]
            for start in range(0, most_tries, 64):
                tried = _slot(h[own][None, :], np.arange(start, start + 64)[:, None], n).astype(np.int64)
                fits = (slots[tried] < 0).all(axis=1)
                if size > 1:
                    s = np.sort(tried, axis=1)
                    fits &= (s[:, 1:] != s[:, :-1]).all(axis=1)
                if fits.any():
                    k = int(np.argmax(fits))
                    shifts[b], slots[tried[k]] = start + k, own
                    break
            else:
                done = False
                break
        if done:
            single = np.flatnonzero(sizes == 1)
            free = np.flatnonzero(slots < 0)
            slots[free] = order[firsts[single]]
            shifts[single] = -free - 1
            return seed, shifts, slots
    raise ValueError("no seed gave a perfect hash; the keys are not distinct")


def _fingerprints(keys: np.ndarray, seed: int) -> np.ndarray:
    return (_hashes(keys, seed ^ 0x5BF0)[1] >> _U(32)).astype("<u4")


# ---------------------------------------------------------------- files


def _local(path: str) -> str:
    """Python on executors writes through a mounted folder; other stores go through pyarrow's file systems."""
    return "/" + path[5:].lstrip("/") if path.startswith("file:") else path


def _open(path: str, mode: str):
    local = _local(path)
    if "://" not in local:
        return open(local, mode)
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner) if mode == "rb" else store.open_output_stream(inner)


def _move(old: str, new: str) -> None:
    if "://" not in _local(new):
        os.replace(_local(old), _local(new))
        return
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(old)
    store.move(inner, fs.FileSystem.from_uri(new)[1])


class ShardWriter:
    """Writes texts' ids as they come; the index follows at the end. A renamed file is whole."""

    def __init__(self, path: str, attempt: str, width: int):
        self.path, self.part, self.width = path, f"{path}.{attempt}.part", width
        self.file, self.ends, self.keys = _open(self.part, "wb"), [0], []
        self.file.write(MAGIC)

    def add(self, key: int | None, ids: bytes) -> None:
        self.file.write(ids)
        self.ends.append(self.ends[-1] + len(ids) // self.width)
        self.keys.append(key)

    def close(self) -> dict:
        null = np.array([k is None for k in self.keys], np.uint8)
        keys = np.array([0 if k is None else k for k in self.keys], "<i8")
        known = np.flatnonzero(null == 0)
        first = known[np.unique(keys[known], return_index=True)[1]]  # repeated keys follow one another: the first is indexed
        seed, shifts, slots = build_index(keys[first])
        rows = first[slots] if len(first) else first
        f = self.file
        f.write(np.array(self.ends, "<i8").tobytes() + keys.tobytes() + null.tobytes())
        f.write(shifts.astype("<i4").tobytes() + rows.astype("<u4").tobytes() + _fingerprints(keys[rows], seed).tobytes())
        f.write(np.array([self.width, self.ends[-1], len(keys), len(first), len(shifts), seed], "<i8").tobytes() + MAGIC)
        f.close()
        _move(self.part, self.path)
        some = keys[known]
        return {"path": self.path, "n_rows": len(keys), "n_ids": self.ends[-1], "least": int(some.min()) if len(some) else None, "most": int(some.max()) if len(some) else None}


class Shard:
    """Reads a shard file: any row, or the rows of a key through the index."""

    def __init__(self, path: str):
        self.path, self.file = path, _open(path, "rb")
        size = self.file.seek(0, 2)
        size = self.file.tell() if size is None else size
        foot = self._at(size - 56, 56)
        if self._at(0, 8) != MAGIC or foot[48:] != MAGIC:
            raise ValueError(f"{path} is not a whole shard")
        self.width, self.n_ids, self.n_rows, self.n_keys, self.n_buckets, self.seed = np.frombuffer(foot[:48], "<i8").tolist()
        self.kind = np.dtype(f"<u{self.width}")
        self.ends_at = 8 + self.n_ids * self.width
        self.keys_at = self.ends_at + 8 * (self.n_rows + 1)
        self.null_at = self.keys_at + 8 * self.n_rows
        self.shifts_at = self.null_at + self.n_rows
        self.rows_at = self.shifts_at + 4 * self.n_buckets
        self.prints_at = self.rows_at + 4 * self.n_keys

    def _at(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def ids(self, row: int) -> np.ndarray:
        a, b = np.frombuffer(self._at(self.ends_at + 8 * row, 16), "<i8").tolist()
        return np.frombuffer(self._at(8 + a * self.width, (b - a) * self.width), self.kind)

    def find(self, key: int) -> list[int]:
        """Rows of a key, by one probe of the index; more than one where the key was given more than once."""
        if not self.n_keys:
            return []
        one = np.array([key], np.int64)
        bucket, h = _hashes(one, self.seed)
        shift = int(np.frombuffer(self._at(self.shifts_at + 4 * int(bucket[0] % _U(self.n_buckets)), 4), "<i4")[0])
        slot = -shift - 1 if shift < 0 else int(_slot(h, shift, self.n_keys)[0])
        if self._at(self.prints_at + 4 * slot, 4) != _fingerprints(one, self.seed).tobytes():
            return []
        row, rows = int(np.frombuffer(self._at(self.rows_at + 4 * slot, 4), "<u4")[0]), []
        while row < self.n_rows and np.frombuffer(self._at(self.keys_at + 8 * row, 8), "<i8")[0] == key and self._at(self.null_at + row, 1) == b"\0":
            rows.append(row)
            row += 1
        return rows

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """The first row of each key by one probe of the index, as find; -1 where the index has no such key."""
        if not self.n_keys:
            return np.full(len(keys), -1)
        bucket, h = _hashes(keys, self.seed)
        shift = np.frombuffer(self._at(self.shifts_at, 4 * self.n_buckets), "<i4")[bucket % _U(self.n_buckets)].astype(np.int64)
        slot = np.where(shift < 0, -shift - 1, _slot(h, np.maximum(shift, 0), self.n_keys).astype(np.int64))
        prints = np.frombuffer(self._at(self.prints_at, 4 * self.n_keys), "<u4")[slot]
        return np.where(prints == _fingerprints(keys, self.seed), np.frombuffer(self._at(self.rows_at, 4 * self.n_keys), "<u4")[slot].astype(np.int64), -1)

    def verify(self) -> None:
        """Probes the index for every stored key; raises where one does not lead to the key's first row."""
        live = np.flatnonzero(np.frombuffer(self._at(self.null_at, self.n_rows), np.uint8) == 0)
        keys, first = np.unique(np.frombuffer(self._at(self.keys_at, 8 * self.n_rows), "<i8")[live], return_index=True)
        if len(keys) != self.n_keys or (self.probe(keys) != live[first]).any():
            raise ValueError(f"{self.path}: the index does not lead to every row")

    def rows(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """All rows in order: key, first id's number in the shard, ids."""
        ends = np.frombuffer(self._at(self.ends_at, 8 * (self.n_rows + 1)), "<i8").tolist()
        keys = np.frombuffer(self._at(self.keys_at, 8 * self.n_rows), "<i8").tolist()
        null = self._at(self.null_at, self.n_rows)
        for i in range(self.n_rows):
            yield None if null[i] else keys[i], ends[i], np.frombuffer(self._at(8 + ends[i] * self.width, (ends[i + 1] - ends[i]) * self.width), self.kind)

    def close(self) -> None:
        self.file.close()


class TokenStore:
    """Shards in key order and, for each, its key range and the number of ids before it."""

    def __init__(self, shards: list[dict]):
        shards = sorted((s for s in shards if s["n_rows"]), key=lambda s: (s["least"] is not None, s["least"] or 0, s["path"]))
        start = 0
        for s in shards:
            s["start"] = start
            start += s["n_ids"]
        self.shards = shards

    def get(self, key: int) -> list[tuple[int, np.ndarray]]:
        """(first id's number in the whole store, ids) of every text stored under a key."""
        out = []
        for s in self.shards:
            if s["least"] is not None and s["least"] <= key <= s["most"]:
                shard = Shard(s["path"])
                out += [(s["start"] + int(np.frombuffer(shard._at(shard.ends_at + 8 * r, 8), "<i8")[0]), shard.ids(r)) for r in shard.find(key)]
                shard.close()
        return out


def write_store(docs: DataFrame, path: str, tokenizer_file: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> TokenStore:
    """Encodes whole texts (null: empty) and writes one shard for each range of ids, in ascending order (null first).

    Texts are dealt out by id range before they are encoded, so each is encoded once. Rows with the same id lie in
    one shard, by text. A task that is run again writes the same file under the same name. Ids that are not whole
    numbers fail. An empty table gives a store without shards. The manifest, one row a shard, is kept as JSON.
    """
    ship(docs.sparkSession)
    local = _local(path)
    if "://" not in local:
        os.makedirs(local, exist_ok=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, out = encoder(tokenizer_file), TaskContext.get(), None
        end = enc.pack([end_id])
        for batch in batches:
            if out is None:
                out = ShardWriter(f"{path}/shard-{task.partitionId():05d}.tok", str(task.taskAttemptId()), enc.width)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for key, ids in zip(batch.column(0).to_pylist(), enc.encode_all(texts)):
                out.add(key, ids + end)
        if out is not None:
            yield pa.RecordBatch.from_pylist([out.close()], schema=_SHARD)

    spread = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).cast("string").alias("t")).repartitionByRange("k").sortWithinPartitions("k", "t")
    store = TokenStore([r.asDict() for r in spread.mapInArrow(frugal(write), "path string, n_rows long, n_ids long, least long, most long").collect()])
    if "://" not in local:
        with open(f"{local}/manifest.json", "w") as f:
            json.dump(store.shards, f)
    return store


_SHARD = pa.schema([("path", pa.string()), ("n_rows", pa.int64()), ("n_ids", pa.int64()), ("least", pa.int64()), ("most", pa.int64())])
_ROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_store(spark, store: TokenStore) -> DataFrame:
    """One row for each stored text, from the files: doc_id, start, n_tokens, ids_crc32.

    Rows come in file order; each shard's index is probed for all its keys first and must lead to their rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                shard, rows = Shard(s["path"]), []
                shard.verify()
                for key, at, ids in shard.rows():
                    rows.append((key, s["start"] + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 10_000:
                        yield _batch(rows)
                        rows = []
                shard.close()
                if rows:
                    yield _batch(rows)

    shards = [(s["path"], s["start"]) for s in store.shards]
    d = spark.createDataFrame(shards, "path string, start long").repartition(max(1, len(shards)))
    return d.mapInArrow(frugal(read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=_ROW)


def encode_documents(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Writes documents to a new store in the shared folder and reads it back.

    Returns doc_id, start, n_tokens, ids_crc32, one row for each row of docs. Extra columns are not read. A null id
    stays null and comes first.
    """
    return read_store(docs.sparkSession, write_store(docs, scratch(docs.sparkSession, "tokens"), tokenizer_file))
