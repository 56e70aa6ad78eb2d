"""Near-duplicate embeddings: rotated binary codes with correction factors, bounds, exact recomputation.

Equal vectors are one node. A random rotation turns a node into a sign code; the code's inner product with the
rotated node corrects an estimate of any inner product, and says how far the estimate can be off. Pairs whose upper
bound lies below the limit are left; the others are computed exactly, in double precision.

Pairs meet in buckets of hashed sign bits, in so many tables that a pair at the limit meets with the chance RECALL; a
closer one meets surely enough. Nodes within half the limit's angle of one leader all link each other, by the
triangle inequality of angles: such a core is counted, not compared. The rest of a bucket is compared in blocks, so
no task holds a whole bucket, and a pair counts in the first table where it meets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import connected_components, cut, frugal, ship, small
from tessera.llm.kernels import mix

#: Chance that a pair at the limit meets in a table.
RECALL = 0.998
#: Nodes that share a bucket by chance, in the mean; nodes in a block at most, in the mean.
BUCKET, BLOCK = 256, 1024
#: Deviations of an estimate that its bound allows for.
SURE = 4.0
#: Differing bits of 64 up to which a node is compared with a bucket's leader.
NEAR_BITS = 18
_U = np.uint64


def tables_for(n: int, limit: float) -> tuple[int, int]:
    """Bits of a table's buckets and number of tables for n nodes."""
    bits = min(40, max(1, round(math.log2(max(n, 2) / BUCKET))))
    same = 1 - math.acos(limit) / math.pi
    return bits, max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - same**bits)))


class Coder:
    """Codes, factors and buckets under rotations that depend on the seed and the width alone."""

    def __init__(self, width: int, bits: int, tables: int, seed: int = 11):
        self.width = max(64, -(-width // 64) * 64)
        rng = np.random.default_rng(seed)
        turns = 1 + -(-bits * tables // self.width)
        self.turns = [np.linalg.qr(rng.standard_normal((self.width, self.width)))[0] for _ in range(turns)]
        self.bits, self.tables = bits, tables

    def padded(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.width))
        out[:, : x.shape[1]] = x
        return out

    def code(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rotated vectors, their signs as +-1/sqrt(width), and the factors <rotated, signs>."""
        turned = unit @ self.turns[0]
        signs = np.where(turned >= 0, 1.0, -1.0) / math.sqrt(self.width)
        return turned, signs, (turned * signs).sum(axis=1)

    def buckets(self, unit: np.ndarray, dims: np.ndarray) -> np.ndarray:
        """One number a table; vectors of different dimension never share one."""
        signs = np.concatenate([unit @ t >= 0 for t in self.turns[1:]], axis=1)[:, : self.bits * self.tables]
        weights = _U(1) << np.arange(self.bits, dtype=_U)
        packed = (signs.reshape(len(unit), self.tables, self.bits) * weights).sum(axis=2, dtype=_U)
        return mix(packed + (dims.astype(_U) << _U(44))[:, None]).view(np.int64)


def first_bits(signs: np.ndarray) -> np.ndarray:
    return np.packbits(signs[:, :64] > 0, axis=1).view(np.int64).ravel()


def unit_rows(vectors: list[np.ndarray], coder: Coder) -> np.ndarray:
    """Rows of length 1 in double precision, filled up with zeros."""
    out = np.zeros((len(vectors), coder.width))
    for i, v in enumerate(vectors):
        v = v.astype(np.float64)
        v = v / np.abs(v).max()
        out[i, : len(v)] = v / np.sqrt((v * v).sum())
    return out


def linked_pairs(x: np.ndarray, y: np.ndarray, coder: Coder, limit: float, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows of x and of y with cosine limit or more among the wanted pairs; and how many pairs were computed exactly."""
    turned, _, _ = coder.code(x)
    _, signs, factor = coder.code(y)
    estimate = (turned @ signs.T) / factor
    slack = np.sqrt(np.maximum(1 - factor**2, 0)) / factor * (SURE / math.sqrt(coder.width - 1))
    i, j = np.nonzero(wanted & (estimate + slack >= limit))
    keep = np.zeros(len(i), bool)
    for a in range(0, len(i), 1 << 16):
        keep[a : a + (1 << 16)] = np.einsum("nd,nd->n", x[i[a : a + (1 << 16)]], y[j[a : a + (1 << 16)]]) >= limit
    return i[keep], j[keep], len(i)


def _is_vector(c: str):
    v = F.col(c)
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return v.isNotNull() & finite & F.exists(v, lambda e: e != 0)


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", limit: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of vectors.

    Two rows link when the cosine of their vectors, in double precision, is limit or more; the check is exact, and a
    pair at the limit is found with the chance RECALL. Vectors that are null, empty, zero, or hold null or non-finite
    components link with nothing, nor do vectors of different dimension. n_links counts the other rows linked, equal
    ones too; component_id is the smallest id that links reach; kept says whether that is the row's own. Other
    columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("i"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.withColumn("v", F.when(_is_vector("v"), F.col("v"))).withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v", F.size("v"))))
    nodes = cut(rows.where("v is not null").groupBy("node").agg(F.count("*").alias("w"), F.min("i").alias("least"), F.first("v").alias("v")))
    n, width = nodes.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    bits, tables = tables_for(n, limit)
    sent = spark.sparkContext.broadcast(Coder(width, bits, tables))

    base = cut(nodes.select("node", "w", "v").mapInArrow(frugal(_encode(sent)), "node long, w long, v binary, code long, buckets array<long>"))
    entries = base.select("node", "code", F.posexplode("buckets").alias("t", "bucket"))
    core = cut(_cores(base, entries, sent, limit))
    links = cut(_cross_links(base, entries, core, sent, limit))

    label = connected_components(links.where("n is null").select("a", "b").union(core.select("node", "core")))
    cross = links.where("n is not null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("cross"))
    inside = core.join(base.select("node", "w"), "node").groupBy("core").agg(F.sum("w").alias("inside"))
    least = _least(nodes.select("node", "least").join(label, "node", "left"))
    told = least.join(core, "node").join(inside, "core").join(cross, "node", "left")
    told = told.select("node", "component_id", (F.col("inside") - 1 + F.coalesce("cross", F.lit(0))).alias("n_links"))
    out = rows.select("i", "node").join(told, "node", "left")
    component = F.coalesce("component_id", "i")
    return out.select(F.col("i").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("i").eqNullSafe(component).alias("kept"))


def _least(labelled: DataFrame) -> DataFrame:
    """node, component_id: the smallest id of each component; nodes without links have their own."""
    best = labelled.where("component is not null").groupBy("component").agg(F.min("least").alias("best"))
    return labelled.join(best, "component", "left").select("node", F.coalesce("best", "least").alias("component_id"))


def _encode(sent):
    schema = pa.schema([("node", pa.int64()), ("w", pa.int64()), ("v", pa.binary()), ("code", pa.int64()), ("buckets", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = sent.value
        for batch in batches:
            if not len(batch):
                continue
            own = [np.asarray(v.values, np.float64) for v in batch.column(2)]
            unit = unit_rows(own, coder)
            _, signs, _ = coder.code(unit)
            buckets = coder.buckets(unit, np.array([len(v) for v in own]))
            # 64-bit components are kept as such; those that came from 32-bit ones travel as these
            packed = [v.astype("<f4").tobytes() if (v.astype("<f4").astype(np.float64) == v).all() else b"\1" * 4 + v.astype("<f8").tobytes() + b"\1" for v in own]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary()), pa.array(first_bits(signs)), pa.array(list(buckets), pa.list_(pa.int64()))], schema=schema)

    return run


def _vector(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed[4:-1], "<f8") if len(packed) % 4 else np.frombuffer(packed, "<f4")


def _cores(base: DataFrame, entries: DataFrame, sent, limit: float) -> DataFrame:
    """node, core: the smallest leader of a shared bucket within half the limit's angle, else the node itself."""
    half = math.cos(math.acos(limit) / 2) + 1e-9
    lead = entries.groupBy("t", "bucket").agg(F.min(F.struct("node", "code")).alias("lead"), F.max("node").alias("last")).where("lead.node <> last")
    lead = cut(lead.select("t", "bucket", F.col("lead.node").alias("lead"), F.col("lead.code").alias("lead_code")))
    near = entries.join(small(lead), ["t", "bucket"]).where(F.bit_count(F.expr("code ^ lead_code")) <= NEAR_BITS).where("node <> lead").select("node", "lead").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = sent.value
        for batch in batches:
            for a in range(0, len(batch), 4096):
                part = batch.slice(a, 4096)
                x, y = (unit_rows([_vector(v) for v in part.column(c).to_pylist()], coder) for c in (2, 3))
                inside = np.einsum("nd,nd->n", x, y) >= half
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["node", "lead"]).filter(pa.array(inside))

    v = base.select(F.col("node"), "v")
    both = near.join(v, "node").join(v.withColumnsRenamed({"node": "lead", "v": "lv"}), "lead").select("node", "lead", "v", "lv")
    found = both.mapInArrow(frugal(run), "node long, lead long").groupBy("node").agg(F.min("lead").alias("lead"))
    return base.select("node").join(found, "node", "left").select("node", F.coalesce("lead", "node").alias("core"))


def _cross_links(base: DataFrame, entries: DataFrame, core: DataFrame, sent, limit: float) -> DataFrame:
    """Links between nodes of different cores: rows (a, null, n) add n linked rows to a; rows (a, b, null) connect a and b."""
    own = entries.select("node", "t", "bucket").join(core, "node")
    by_core = own.groupBy("t", "bucket", "core").agg(F.count("*").alias("n"))
    mixed = by_core.groupBy("t", "bucket").agg(F.sum("n").alias("all"), F.max(F.struct("n", "core")).alias("main")).where("main.n < all")
    blocks = lambda c: F.ceil(c / BLOCK).cast("int")
    mixed = cut(mixed.select("t", "bucket", F.col("main.core").alias("main_core"), blocks(F.col("main.n")).alias("mains"), blocks(F.col("all") - F.col("main.n")).alias("others")))
    own = own.join(small(mixed), ["t", "bucket"])
    # Blocks of the bucket's main core meet blocks of the others; these meet each other, too.
    is_main = F.col("core") == F.col("main_core")
    block = F.pmod(F.xxhash64("node", "t"), F.when(is_main, F.col("mains")).otherwise(F.col("others"))).cast("int")
    own = own.withColumns({"main": is_main, "block": block})
    with_mains = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda k: F.struct(k.alias("p"), F.col("block").alias("q")))
    with_others = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda k: F.struct((-1 - F.least(k, F.col("block"))).alias("p"), F.greatest(k, F.col("block")).alias("q")))
    with_main_row = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda k: F.struct(F.col("block").alias("p"), k.alias("q")))
    jobs = own.select("node", "core", "t", "bucket", "main", "block", F.explode(F.when(F.col("main"), with_main_row).otherwise(F.concat(with_mains, with_others))).alias("job"))
    jobs = jobs.select("node", "core", "t", "bucket", "main", "block", "job.p", "job.q").join(base.select("node", "w", "v", "buckets"), "node")

    def run(table: pa.Table) -> pa.Table:
        coder = sent.value
        p, t = table.column("p")[0].as_py(), table.column("t")[0].as_py()
        main, block = np.array(table.column("main")), np.array(table.column("block"))
        node, cores, w = (np.array(table.column(c)) for c in ("node", "core", "w"))
        unit = unit_rows([_vector(v) for v in table.column("v").to_pylist()], coder)
        buckets = np.array(table.column("buckets").to_pylist(), np.int64)
        if p >= 0:
            left, right = np.flatnonzero(main), np.flatnonzero(~main)
        else:
            left, right = np.flatnonzero(block == -1 - p), np.flatnonzero(block == table.column("q")[0].as_py())
        wanted = cores[left][:, None] != cores[right][None, :]
        if p < 0 and -1 - p == table.column("q")[0].as_py():
            wanted &= node[left][:, None] < node[right][None, :]
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        if not wanted.any():
            return none
        i, j, _ = linked_pairs(unit[left], unit[right], coder, limit, wanted)
        i, j = left[i], right[j]
        met = np.zeros(len(i), bool)  # in an earlier table
        for k in range(t):
            met |= buckets[i, k] == buckets[j, k]
        i, j = i[~met], j[~met]
        if not len(i):
            return none
        n = np.bincount(i, w[j], len(node)) + np.bincount(j, w[i], len(node))
        counted = np.flatnonzero(n)
        # One edge a node connects what the block links: each node to the smallest row that it reaches here.
        reach = np.arange(len(node))
        while True:
            low = np.minimum(reach[i], reach[j])
            new = reach.copy()
            np.minimum.at(new, i, low)
            np.minimum.at(new, j, low)
            new = new[new]
            if (new == reach).all():
                break
            reach = new
        edge = np.flatnonzero(reach != np.arange(len(node)))
        a = pa.array(np.concatenate([node[counted], node[edge]]))
        b = pa.concat_arrays([pa.nulls(len(counted), pa.int64()), pa.array(node[reach[edge]])])
        c = pa.concat_arrays([pa.array(n[counted].astype(np.int64)), pa.nulls(len(edge), pa.int64())])
        return pa.table({"a": a, "b": b, "n": c})

    return jobs.groupBy("t", "bucket", "p", "q").applyInArrow(run, "a long, b long, n long")


ORACLE_SQL = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings
), ok as (
  select * from v where len(e) > 0 and list_bool_and(list_transform(e, lambda x: coalesce(isfinite(x), false))) and list_bool_or(list_transform(e, lambda x: x <> 0))
), links as (
  select a.vec_id as a, b.vec_id as b from ok a join ok b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.9
), reach(vec_id, other) as (select vec_id, vec_id from v union select r.vec_id, l.b from reach r join links l on r.other = l.a
), n as (select a, count(*) as n from links group by a)
select v.vec_id, coalesce(n.n, 0)::bigint as n_links, c.component_id, v.vec_id = c.component_id as kept
from v join (select vec_id, min(other)::bigint as component_id from reach group by vec_id) c using (vec_id) left join n on n.a = v.vec_id
"""
