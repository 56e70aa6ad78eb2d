"""Token counts as delta-maintained rollups: signed changes, idempotent batches, additive totals."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType, StringType, StructField, StructType

KEYS = ["source", "lang", "tokenizer"]
_DELTA = StructType([*(StructField(c, StringType()) for c in KEYS), StructField("docs", LongType()), StructField("tokens", LongType())])

#: Tokenizers that SQL expresses: runs of what is not white space; runs of letters or digits, and every other mark alone.
WORDS = r"[^\x20\x09-\x0D]+"
MARKS = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]"


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORDS)).cast("long")


def marks(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(MARKS)).cast("long")


def file_tokenizer(path: str) -> Callable[[Column], Column]:
    """Counts by a tokenizers file, in Arrow batches."""
    @pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        from tessera.llm.op9_tokens import encoder

        enc = encoder(path)
        return pd.Series([len(ids) // enc.width for ids in enc.encode_all([t or "" for t in texts])], dtype="int64")

    return lambda text: count(text.cast("string"))


class Rollup:
    """Totals of documents and tokens by source, language and tokenizer version, kept as committed deltas.

    A batch of changes is reduced to one row a key and written to a folder of its own attempt. The commit is the creation
    of the batch's marker, a small file that names the folder and is created only if it is absent: of two drivers with one
    batch, one succeeds, and a replay after a lost driver or a second delivery changes nothing. Folders that no marker
    names count for nothing. Totals are the sums of all committed deltas; compact() sums them into a snapshot, whose marker
    names its folder and the batches in it. A store that creates files without looking would need a lock instead.

    Changes have op, source, lang, tokenizer, tokens, and where wanted old_tokens for revisions and n, the number of
    documents that a row stands for (null or absent: 1): insert adds n documents of so many tokens, delete takes them away,
    revise changes their tokens from old_tokens. Null tokens count 0, null keys are a key of their own, another op fails.
    Keys whose sums are all 0 are left out. An empty batch is committed as any other.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for part in ("commits", "deltas", "snapshots"):
            self._fs.mkdirs(self._path(f"{self.path}/{part}"))

    def _names(self, part: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.path}/{part}")) if not s.getPath().getName().startswith("."))

    def _mark(self, marker: str, text: str) -> bool:
        """Creates a marker; False where it is there already."""
        if self._fs.exists(self._path(marker)):
            return False
        try:
            out = self._fs.create(self._path(marker), False)
        except Py4JJavaError:
            if self._fs.exists(self._path(marker)):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _read(self, marker: str) -> list[str]:
        return [r.value for r in self.spark.read.text(marker).collect()]

    def _snapshot(self) -> tuple[str | None, set[str]]:
        """The newest snapshot's folder and the batches in it."""
        names = self._names("snapshots")
        if not names:
            return None, set()
        folder, *held = self._read(f"{self.path}/snapshots/{names[-1]}")
        return folder, set(held)

    def committed(self) -> set[str]:
        return set(self._names("commits"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Applies a batch once; False if it was applied before."""
        if batch in self.committed():
            return False
        known = lambda c, other: F.coalesce(F.col(c).cast("long"), F.lit(other)) if c in changes.columns else F.lit(other).cast("long")
        sign = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).when(F.col("op") == "revise", 0)
        sign = F.coalesce(sign, F.raise_error(F.concat(F.lit("unknown op: "), F.coalesce("op", F.lit("null")))).cast("int"))
        tokens, old, n = known("tokens", 0), known("old_tokens", 0), known("n", 1)
        moved = F.when(F.col("op") == "revise", tokens - old).otherwise(sign * tokens)
        delta = changes.groupBy(*(F.col(c).cast("string").alias(c) for c in KEYS)).agg(F.sum(sign * n).cast("long").alias("docs"), F.sum(moved * n).alias("tokens"))
        folder = f"{self.path}/deltas/{batch}-{uuid.uuid4().hex}"
        delta.write.parquet(folder)
        if not self._mark(f"{self.path}/commits/{batch}", folder):
            self._fs.delete(self._path(folder), True)
            return False
        return True

    def _deltas(self) -> tuple[DataFrame, set[str]]:
        snapshot, held = self._snapshot()
        names = sorted(self.committed() - held)
        paths = [self._read(f"{self.path}/commits/{n}")[0] for n in names] + ([snapshot] if snapshot else [])
        read = self.spark.read.schema(_DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], _DELTA)
        return read, held | set(names)

    def totals(self) -> DataFrame:
        sums = self._deltas()[0].groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Sums all committed deltas into a new snapshot and removes their folders; their batches stay known."""
        read, held = self._deltas()
        names = self._names("snapshots")
        number = int(names[-1]) + 1 if names else 1
        folder = f"{self.path}/deltas/snapshot-{uuid.uuid4().hex}"
        self.totals().write.parquet(folder)
        if not self._mark(f"{self.path}/snapshots/{number:08d}", "\n".join([folder, *sorted(held)])):
            self._fs.delete(self._path(folder), True)  # another driver was first
            return
        for path in {f.rpartition("/")[0] for f in read.inputFiles()}:
            self._fs.delete(self._path(path), True)


def count_documents(docs: DataFrame, rollup: Rollup, *, tokenizers: dict[str, Callable[[Column], Column]], batch: str = "all") -> DataFrame:
    """Brings a rollup to the state of docs through three batches and returns its totals.

    First every document comes in with n_chars / 4 as an estimate for each tokenizer; then real counts revise the
    estimates; then documents that repeat an earlier text (the smallest id stays; of equal ids one) are deleted. The
    second batch is sent twice, as a source that delivers at least once would. Null and empty texts are one text without
    tokens; an empty table gives no totals. Texts are known by SHA-256. Extra columns are not read.
    """
    estimate = F.coalesce(F.floor(F.col("n_chars") / 4), F.lit(0)).cast("long")
    counted = F.explode(F.array(*[F.struct(F.lit(name).alias("tokenizer"), f(F.col("text")).alias("tokens")) for name, f in tokenizers.items()])).alias("c")
    each = docs.select("doc_id", "source", "lang", F.coalesce("text", F.lit("")).alias("text"), estimate.alias("estimate"))
    names = F.explode(F.array(*map(F.lit, tokenizers))).alias("tokenizer")
    rollup.commit(f"{batch}-1", each.select(F.lit("insert").alias("op"), "source", "lang", names, F.col("estimate").alias("tokens")))
    real = each.select(F.lit("revise").alias("op"), "source", "lang", counted, F.col("estimate").alias("old_tokens")).select("op", "source", "lang", "c.*", "old_tokens")
    rollup.commit(f"{batch}-2", real)
    rollup.commit(f"{batch}-2", real)
    # Copies: one row a text with what all its rows add up to but the first, by sums that combine before the shuffle.
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "source", "lang")
    texts = each.select(F.sha2("text", 256).alias("h"), "doc_id", "source", "lang", *(f(F.col("text")).alias(f"n{k}") for k, f in enumerate(tokenizers.values())))
    same = texts.groupBy("h", "source", "lang").agg(F.count("*").alias("n"), F.min(first).alias("own"), *(F.max(f"n{k}").alias(f"n{k}") for k in range(len(tokenizers))))
    keep = same.groupBy("h").agg(F.min("own").alias("keep"), F.sum("n").alias("all")).where(F.col("all") > 1)
    gone = same.join(keep, "h").withColumn("gone", F.col("n") - F.when(F.col("own") == F.col("keep"), 1).otherwise(0))
    per = F.explode(F.array(*[F.struct(F.lit(name).alias("tokenizer"), (F.col(f"n{k}")).alias("tokens")) for k, name in enumerate(tokenizers)])).alias("c")
    gone = gone.where("gone > 0").select(F.lit("delete").alias("op"), "source", "lang", per, F.col("gone").alias("n")).select("op", "source", "lang", "c.*", "n")
    rollup.commit(f"{batch}-3", gone)
    return rollup.totals()


ORACLE_SQL = rf"""
with d as (
  select source, lang, coalesce(text, '') as text,
    row_number() over (partition by coalesce(text, '') order by doc_id nulls last, source nulls first, lang nulls first) as copy
  from documents
), c as (
  select source, lang, len(regexp_extract_all(text, '{WORDS}')) as words, len(regexp_extract_all(text, '{MARKS}')) as marks from d where copy = 1
)
select source, lang, 'words-1' as tokenizer, count(*)::bigint as docs, sum(words)::bigint as tokens from c group by source, lang
union all
select source, lang, 'marks-1', count(*)::bigint, sum(marks)::bigint from c group by source, lang
"""
