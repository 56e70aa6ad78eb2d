"""Tables in files: tab-separated sources, Parquet caches, truth, result files, JSON side files, experiment logs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions.text import normalized


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


SOURCE = _strings("entity_id", "business_name", "business_address", "country")
TRUTH_WIDE = _strings("source1_entity_id", "matched_entity_ids")


def read_tsv(spark: SparkSession, path: str, schema: StructType = SOURCE) -> DataFrame:
    """A tab-separated table with a header, all strings: quotes double inside quotes, no spelling is null, empty is empty."""
    d = spark.read.schema(schema).options(sep="\t", header=True, quote='"', escape='"', nullValue="\x00", mode="PERMISSIVE", multiLine=False).csv(path)
    return d.select(*(F.coalesce(c, F.lit("")).alias(c) for c in schema.names))


def exploded_truth(wide: DataFrame) -> DataFrame:
    """entity_id_s1, entity_id_other: one row a match; empty lists give none."""
    other = F.explode(F.split("matched_entity_ids", ",")).alias("entity_id_other")
    return wide.where(F.length("matched_entity_ids") > 0).select(F.col("source1_entity_id").alias("entity_id_s1"), other)


class Store:
    """Parquet forms of the tables of a data folder, written once and read again while their source file is unchanged.

    raw: folder with <split>/<split>_source<k>.tsv and <split>_ground_truth.tsv; cache: folder for the Parquet forms.
    A form keeps the size and time of the file that it came from beside it.
    """

    def __init__(self, spark: SparkSession, raw: str, cache: str):
        self.spark, self.raw, self.cache = spark, raw.rstrip("/"), cache.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _status(self, path: str):
        p = self._path(path)
        fs = p.getFileSystem(self._conf)
        return fs.getFileStatus(p) if fs.exists(p) else None

    def file(self, split: str, table: str) -> str:
        return f"{self.raw}/{split}/{split}_{table}.tsv"

    def _cached(self, split: str, table: str, form: str, build, force: bool = False) -> DataFrame:
        source = self._status(self.file(split, table))
        if source is None:
            raise FileNotFoundError(self.file(split, table))
        stamp = {"size": source.getLen(), "time": source.getModificationTime()}
        target = f"{self.cache}/{split}/{table}_{form}"
        if force or read_json(self.spark, f"{target}.json", None) != stamp or self._status(f"{target}/_SUCCESS") is None:
            build().write.mode("overwrite").parquet(target)
            write_json(self.spark, f"{target}.json", stamp)
        return self.spark.read.parquet(target)

    def source(self, split: str, k: int, columns: list[str] | None = None, *, force: bool = False) -> DataFrame:
        """Source k; columns prune the scan."""
        table = f"source{k}"
        d = self._cached(split, table, "raw", lambda: read_tsv(self.spark, self.file(split, table)), force)
        return d.select(*columns) if columns else d

    def ids(self, split: str, k: int) -> DataFrame:
        return self.source(split, k, ["entity_id"])

    def subset(self, split: str, k: int, ids: DataFrame | list[str], columns: list[str] | None = None) -> DataFrame:
        """Rows of the given ids: a short list is pushed into the scan, a table is semi-joined."""
        d = self.source(split, k, columns)
        return d.where(F.col("entity_id").isin(ids)) if isinstance(ids, list) else d.join(ids.select("entity_id"), "entity_id", "left_semi")

    def normalized(self, split: str, k: int, columns: list[str] | None = None, *, force: bool = False) -> DataFrame:
        d = self._cached(split, f"source{k}", "normalized", lambda: normalized(self.source(split, k, force=force)), force)
        return d.select(*columns) if columns else d

    def truth(self, split: str = "train") -> DataFrame:
        return self._cached(split, "ground_truth", "raw", lambda: read_tsv(self.spark, self.file(split, "ground_truth"), TRUTH_WIDE))

    def truth_pairs(self, split: str = "train") -> DataFrame:
        return self._cached(split, "ground_truth", "pairs", lambda: exploded_truth(self.truth(split)))

    def build_all(self, splits=("train", "test"), *, force: bool = False) -> None:
        for split in splits:
            for k in (1, 2, 3):
                self.normalized(split, k, force=force)
            if self._status(self.file(split, "ground_truth")):
                self.truth_pairs(split)

    def audit(self, splits=("train", "test")) -> dict:
        """Presence, rows and MB of every source file; ok is False where one is missing."""
        out: dict = {"files": {}, "ok": True}
        for split in splits:
            for k in (1, 2, 3):
                found = self._status(self.file(split, f"source{k}"))
                rows = self.source(split, k).count() if found else None
                out["files"][f"{split}_source{k}"] = {"exists": found is not None, "rows": rows, "mb": round(found.getLen() / 1e6, 3) if found else None}
                out["ok"] &= found is not None
        return out


def write_results(pairs_or_lists: DataFrame, path: str, *, single_file: bool = False) -> None:
    """A tab-separated result table with a header; one file on demand."""
    d = pairs_or_lists.coalesce(1) if single_file else pairs_or_lists
    d.write.mode("overwrite").options(sep="\t", header=True, emptyValue="", quote="").csv(path)


def append_results(lists: DataFrame, path: str) -> None:
    """Adds rows (an id and a comma-joined list) to a result folder, whose part files each have the header.

    Fails before anything is written where a row's id repeats among them or a list breaks the rules of results.
    """
    from tessera.operators.validate import OutputFormatError, violations

    bad = violations(lists, lists.select(F.col(lists.columns[0]).alias("entity_id"))).first()
    if bad is not None:
        raise OutputFormatError(f"{bad.check}: {bad.id}")
    lists.write.mode("append").options(sep="\t", header=True, emptyValue="", quote="").csv(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, _strings("source1_entity_id", "ids"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """entity_id: the distinct first fields of a tab-separated file with a header, trimmed, blanks left out."""
    first = spark.read.options(sep="\t", header=True, quote="").csv(path)
    return first.select(F.trim(F.col(f"`{first.columns[0]}`")).alias("entity_id")).where("entity_id <> ''").distinct()


def read_json(spark: SparkSession, path: str, default):
    """A JSON side file; default where it is absent or broken."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return default
    try:
        return json.loads("\n".join(r.value for r in spark.read.text(path).collect()))
    except ValueError:
        return default


def write_json(spark: SparkSession, path: str, value) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(json.dumps(value, indent=1, sort_keys=True).encode()))
    out.close()


def append_experiments(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """The experiment log with rows added; columns that one side lacks are null. The log's old files are kept until the new are whole."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        rows = rows.unionByName(spark.read.parquet(path).limit(0), allowMissingColumns=True)
    rows.write.mode("append").parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)
