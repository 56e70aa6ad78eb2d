"""A stored blocking index: the postings of one side, built once and looked up by many."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import blocking
from tessera.sources.files import read_json, write_json


class BlockingIndex:
    """Postings (rule, source, key, entity_id, occurrences) of normalised records, in one folder for each rule, sorted by key.

    A stamp says what the index was built from; build() with the same stamp leaves it as it is.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def stamp(self):
        """The stamp of a whole index, else None."""
        return read_json(self.spark, f"{self.path}/stamp.json", None)

    def build(self, records: DataFrame, stamp, *, force: bool = False) -> bool:
        """Writes the index of records; False where one with this stamp stands already."""
        if not force and self.stamp() == stamp:
            return False
        write_json(self.spark, f"{self.path}/stamp.json", None)  # not whole while it is written
        entries = blocking.postings(records).withColumn("source", blocking.source_of("entity_id"))
        entries.repartition("rule", "key").sortWithinPartitions("rule", "key").write.mode("overwrite").partitionBy("rule").parquet(f"{self.path}/postings")
        write_json(self.spark, f"{self.path}/stamp.json", stamp)
        return True

    def postings(self) -> DataFrame:
        if self.stamp() is None:
            raise FileNotFoundError(f"no whole index in {self.path}")
        schema = "entity_id string, key string, occurrences int, source string, rule string"
        return self.spark.read.schema(schema).parquet(f"{self.path}/postings")

    def pairs(self, left: DataFrame, *, max_block: int = blocking.MAX_BLOCK, rare_limit: int = blocking.RARE_LIMIT, scope: str | None = None) -> DataFrame:
        """What blocking.pairs_by_rule gives for left and the indexed records."""
        l = blocking.postings(left)
        l = l.join(left.select("entity_id", scope), "entity_id") if scope else l
        return blocking.matched(l, self.postings(), max_block=max_block, rare_limit=rare_limit, scope=scope)
