"""Session helpers shared by the operators: shared folder, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import atexit
import ctypes
import functools
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera import session

#: Rows up to which a side of a join may be broadcast; a larger side is shuffled.
BROADCAST_ROWS = 50_000
#: Bytes of one Arrow batch, where the session's own settings do not say; a longer text is a batch of its own.
BATCH_BYTES = 8 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"

_own_dirs: list[str] = []


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package, and bounds what they and the JVM hold of a partition at a time."""
    session.ship(spark)
    if not spark.sparkContext.getConf().contains(_BATCH_KEY):
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, whose worker gives its free memory back to the system at the end of a task instead of keeping it for the next."""

    @functools.wraps(run)
    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # not glibc
                pass

    return inner


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir; on one machine, where that is unset, an own one."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or getattr(sc, "_tessera_dir", None)
    if path is None:
        found = sc._jsc.sc().getCheckpointDir()
        path = found.get() if found.isDefined() else None
    if path is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tessera-")
        _own_dirs.append(path[7:])
        sc._tessera_dir = path
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder name below the shared folder; it goes when the driver ends."""
    path = f"{shared_dir(spark)}/tessera-{kind}-{uuid.uuid4().hex}"
    atexit.register(_remove, path)
    return path


def _remove(path: str) -> None:
    if path.startswith("file:"):
        shutil.rmtree("/" + path[5:].lstrip("/"), ignore_errors=True)


@atexit.register
def _remove_own() -> None:
    for d in _own_dirs:
        shutil.rmtree(d, ignore_errors=True)


def cut(df: DataFrame) -> DataFrame:
    """Computes df once and cuts its lineage in the shared folder, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _plain(df: DataFrame) -> DataFrame:
    """A cut table without the size estimate of its origin: estimates of joins are products, and those of rounds of joins
    grow to numbers that hold up the planner."""
    session, own = df.sparkSession, df._jdf
    return DataFrame(session._jsparkSession.internalCreateDataFrame(own.queryExecution().toRdd(), own.schema(), False), session)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if it has at most limit rows, else as it is, for a shuffled join."""
    if df.limit(limit + 1).count() <= limit:
        return F.broadcast(df)
    return df


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph.

    edges: columns a, b (same orderable type, not null). Returns node, component, the smallest node reachable.
    Nodes without an edge do not appear. Every edge points from its greater end x to a parent p. A round gives each x its
    least parent, tells its other parents of that one, and replaces parents by their own least parents, so paths halve.
    Only parents that have parents themselves are looked up: the root of a large component, which most rows point to, is no
    key of that join, and where few are left they are broadcast.
    """
    own = F.struct(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("p"))
    rows = edges.where("a <> b").select(own.alias("e")).select("e.*")
    while True:
        dealt = rows.repartition("x").distinct()
        told = dealt.join(dealt.groupBy("x").agg(F.min("p").alias("m")), "x")
        several = told.where("p <> m").select(F.col("p").alias("x"), F.col("m").alias("p"), F.lit(True).alias("c"))
        told = _plain(cut(told.select("x", F.col("m").alias("p"), (F.col("p") != F.col("m")).alias("c")).union(several)))
        up = told.groupBy(F.col("x").alias("p")).agg(F.min("p").alias("r"))
        jumps = _plain(cut(told.select("p").distinct().join(up, "p")))
        if not jumps.limit(1).count() and not told.where("c").limit(1).count():
            break
        rows = told.join(small(jumps), "p", "left").select("x", F.coalesce("r", "p").alias("p"))
    roots = told.select(F.col("p").alias("node"), F.col("p").alias("component")).distinct()
    return told.select(F.col("x").alias("node"), F.col("p").alias("component")).union(roots)
