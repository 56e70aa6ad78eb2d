"""Pair classifiers: a fixed rule and Spark ML estimators behind one interface."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F


#: Features that the rule reads.
RULE_COLUMNS = ("name_token_sort_ratio", "addr_token_sort_ratio", "name_exact_compact_match", "addr_number_exact_seq")


def rule_score() -> Column:
    """0.5 name order-free ratio + 0.3 address order-free ratio + 0.2 of exact forms, within 0 and 1."""
    exact = 0.6 * F.col("name_exact_compact_match") + 0.4 * F.col("addr_number_exact_seq")
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.5 * F.col("name_token_sort_ratio") + 0.3 * F.col("addr_token_sort_ratio") + 0.2 * exact))


def _logistic(**kw):
    return [StandardScaler(inputCol="raw", outputCol="vector", withMean=True), LogisticRegression(featuresCol="vector", weightCol="weight", regParam=kw.pop("regParam", 1e-4), maxIter=kw.pop("maxIter", 200), **kw)]


def _forest(**kw):
    return [RandomForestClassifier(featuresCol="raw", weightCol="weight", numTrees=kw.pop("numTrees", 300), maxDepth=kw.pop("maxDepth", 16), minInstancesPerNode=kw.pop("minInstancesPerNode", 5), seed=42, **kw)]


def _extra_trees(**kw):
    """Spark has no trees with random cuts; the nearest is a forest of few, coarse bins and small feature subsets."""
    return [RandomForestClassifier(featuresCol="raw", weightCol="weight", numTrees=kw.pop("numTrees", 300), maxDepth=kw.pop("maxDepth", 16), minInstancesPerNode=kw.pop("minInstancesPerNode", 5), maxBins=kw.pop("maxBins", 8), featureSubsetStrategy="log2", bootstrap=False, seed=42, **kw)]


def _boosted(**kw):
    return [GBTClassifier(featuresCol="raw", weightCol="weight", maxDepth=kw.pop("maxDepth", 8), maxIter=kw.pop("maxIter", 300), stepSize=kw.pop("stepSize", 0.08), seed=42, **kw)]


#: Training rows of a partition, in the mean: boosting runs thousands of jobs, each of which starts a task for every partition.
PART_ROWS = 1 << 13

#: Estimators by name; add to it to register another. The numbers in them, and the rule's weights, are fixed values.
BUILDERS = {"logistic": _logistic, "forest": _forest, "extra_trees": _extra_trees, "boosted": _boosted}


class PairModel:
    """A fitted classifier and the feature columns it reads; name 'rule' needs no fit."""

    def __init__(self, name: str, columns: list[str], model: PipelineModel | None = None):
        self.name, self.columns, self.model = name, columns, model

    @classmethod
    def fit(cls, name: str, table: DataFrame, columns: list[str], *, kept: bool = False, **kw) -> PairModel:
        """Fits on table (columns, label); classes weigh the same in sum. kept: table is a part of a persisted one, of which no
        second copy is made."""
        if name == "rule":
            return cls(name, columns)
        # the features are made in as many tasks as table has and kept, but fitted in few
        made = table.select("label", *columns)
        made = made if kept else made.persist()
        n = {r.label: r["count"] for r in made.groupBy("label").count().collect()}
        total = sum(n.values())
        weight = F.when(F.col("label") == 1, total / (2 * max(1, n.get(1, 0)))).otherwise(total / (2 * max(1, n.get(0, 0))))
        data = cls._numeric(made.coalesce(max(1, -(-total // PART_ROWS))), columns).withColumns({"label": F.col("label").cast("double"), "weight": weight})
        stages = [VectorAssembler(inputCols=columns, outputCol="raw"), *BUILDERS[name](**kw)]
        fitted = Pipeline(stages=stages).fit(data)
        if not kept:
            made.unpersist()
        return cls(name, columns, fitted)

    @staticmethod
    def _numeric(table: DataFrame, columns: list[str]) -> DataFrame:
        return table.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})

    def score(self, table: DataFrame) -> DataFrame:
        """The ids (and label, where there is one) with score."""
        keep = ["entity_id_s1", "entity_id_other", *(["label"] if "label" in table.columns else [])]
        if self.model is None:
            return table.select(*keep, rule_score().alias("score"))
        out = self.model.transform(self._numeric(table, self.columns))
        return out.select(*keep, vector_to_array("probability")[1].alias("score"))

    def save(self, path: str) -> None:
        if self.model is not None:
            self.model.write().overwrite().save(f"{path}/model")

    @classmethod
    def load(cls, name: str, columns: list[str], path: str) -> PairModel:
        return cls(name, columns, None if name == "rule" else PipelineModel.load(f"{path}/model"))
