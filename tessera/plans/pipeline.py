"""Training and inference as chains of DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, functions as F

from tessera.functions.text import normalized
from tessera.operators import blocking, decide, features, retrieval, sampling
from tessera.operators.models import RULE_COLUMNS, PairModel
from tessera.sources.files import read_json, write_json


@dataclass
class Settings:
    """What shapes candidates and features; kept with a model, so that serving uses what training used."""

    max_block: int = blocking.MAX_BLOCK
    rare_limit: int = blocking.RARE_LIMIT
    tfidf: bool = True
    tfidf_k: int = 20
    seed: int = 42
    validation_fraction: float = 0.25
    models: list[str] = field(default_factory=lambda: ["rule", "logistic", "forest", "boosted"])
    model_options: dict = field(default_factory=dict)


def candidates(left: DataFrame, right: DataFrame, s: Settings) -> DataFrame:
    """Wide candidate pairs of normalised records: rules, and retrieval by name and address where it is on."""
    found = blocking.pairs_by_rule(left, right, max_block=s.max_block, rare_limit=s.rare_limit)
    if not s.tfidf:
        return blocking.flagged(found)
    found = found.withColumn("score", F.lit(None).cast("double"))
    for column in ("name_alnum", "address_alnum"):
        found = found.unionByName(retrieval.retrieve(left, right, column, k=s.tfidf_k).drop("rank"))
    return blocking.flagged(found)


def feature_table(left: DataFrame, right: DataFrame, s: Settings, idf: dict[str, DataFrame], only: Sequence[str] | None = None) -> DataFrame:
    pairs = candidates(left, right, s)
    for side, tokens in (("name", "name_tokens"), ("address", "address_tokens")):
        left, right = (features.with_rarity(d, idf[side], tokens, side) for d in (left, right))
    return features.features(pairs, left, right, only)


def idf_tables(*records: DataFrame) -> dict[str, DataFrame]:
    both = records[0]
    for r in records[1:]:
        both = both.unionByName(r)
    return {side: features.idf_table(both, f"{side}_tokens") for side in ("name", "address")}


def scored(left: DataFrame, right: DataFrame, model: PairModel, s: Settings, idf: dict[str, DataFrame] | None = None) -> DataFrame:
    """Candidate pairs of records with their scores."""
    l, r = normalized(left), normalized(right)
    table = feature_table(l, r, s, idf or idf_tables(l, r), RULE_COLUMNS if model.name == "rule" else None)
    return model.score(table)


def link(left: DataFrame, right: DataFrame, *, model: PairModel | None = None, threshold: float = 0.61, settings: Settings | None = None, idf: dict[str, DataFrame] | None = None, min_gap: float | None = None, single_parent: bool = False, max_block: int | None = None) -> DataFrame:
    """source1_entity_id, matched_entity_ids for every left record; the fixed rule scores where no model is given."""
    s = settings or Settings()
    if max_block is not None:
        s = replace(s, max_block=max_block)
    scores = scored(left, right, model or PairModel("rule", []), s, idf)
    return decide.match_lists(decide.decide(scores, threshold, min_gap=min_gap, single_parent=single_parent), left)


@dataclass
class Trained:
    model: PairModel
    threshold: float
    settings: Settings
    idf: dict[str, DataFrame]
    results: list[dict]

    def save(self, path: str) -> None:
        """Model, token weights, threshold and settings in one folder; the winner is always written, the rule too."""
        spark = self.idf["name"].sparkSession
        self.model.save(path)
        for side, table in self.idf.items():
            table.write.mode("overwrite").parquet(f"{path}/idf_{side}")
        write_json(spark, f"{path}/manifest.json", {"model": self.model.name, "columns": self.model.columns, "threshold": self.threshold, "settings": asdict(self.settings), "results": self.results})

    @classmethod
    def load(cls, spark, path: str) -> Trained:
        m = read_json(spark, f"{path}/manifest.json", None)
        if m is None:
            raise FileNotFoundError(f"{path}/manifest.json")
        idf = {side: spark.read.parquet(f"{path}/idf_{side}") for side in ("name", "address")}
        return cls(PairModel.load(m["model"], m["columns"], path), m["threshold"], Settings(**m["settings"]), idf, m["results"])

    def link(self, left: DataFrame, right: DataFrame, **policy) -> DataFrame:
        return link(left, right, model=self.model, threshold=self.threshold, settings=self.settings, idf=self.idf, **policy)


def train(left: DataFrame, right: DataFrame, truth: DataFrame, settings: Settings | None = None) -> Trained:
    """Fits every model of the settings on train entities and keeps the one of the best macro F0.5 on the others.

    left, right: records; truth: entity_id_s1, entity_id_other. Entities are split, so no pair is on both sides; the
    first of equal models wins, and of equal thresholds the lowest.
    """
    s = settings or Settings()
    l, r = normalized(left).persist(), normalized(right).persist()
    idf = idf_tables(l, r)
    table = decide.labels(feature_table(l, r, s, idf), truth)
    parts = sampling.split(left, s.validation_fraction, s.seed).withColumnRenamed("entity_id", "entity_id_s1")
    table = table.join(parts, "entity_id_s1").persist()
    columns = [c for c in features.feature_columns(table) if c != "part"]
    held = parts.where("part = 'validation'").select(F.col("entity_id_s1").alias("entity_id"))
    own = truth.join(held.withColumnRenamed("entity_id", "entity_id_s1"), "entity_id_s1", "left_semi")
    best, results = None, []
    for name in s.models:
        model = PairModel.fit(name, table.where("part = 'train'"), columns, kept=True, **s.model_options.get(name, {}))
        scores = model.score(table.where("part = 'validation'")).persist()
        coarse = decide.threshold_table(scores, own, held)
        fine = decide.threshold_table(scores, own, held, decide.fine_grid(decide.best_threshold(coarse)))
        row = fine.orderBy(F.desc("macro_f05"), "threshold").first().asDict()
        scores.unpersist()
        results.append({"model": name, **row})
        if best is None or row["macro_f05"] > best[0]:
            best = (row["macro_f05"], model, row["threshold"])
    for d in (l, r, table):
        d.unpersist()
    return Trained(best[1], best[2], s, idf, results)
