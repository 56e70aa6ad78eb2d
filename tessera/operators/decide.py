"""From scores to matches: thresholds, policies, metrics. Scores have entity_id_s1, entity_id_other, score."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window, functions as F

# Threshold grids, rounded to two places.
COARSE = tuple(round(0.30 + 0.05 * i, 2) for i in range(14))
BY_SOURCE = tuple(round(0.30 + 0.02 * i, 2) for i in range(33))
PAIR = ["entity_id_s1", "entity_id_other"]


def accepted(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.where(F.col("score") >= threshold)


def one_parent(scores: DataFrame, *by: str) -> DataFrame:
    """Of each other id the pair of the best score; ties go to the smaller s1 id."""
    w = Window.partitionBy("entity_id_other", *by).orderBy(F.desc("score"), "entity_id_s1")
    return scores.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def drop_ambiguous_top1(scores: DataFrame, min_gap: float) -> DataFrame:
    """Without the best pair of an entity whose lead over the second is under min_gap (no second: lead over -1). Lower pairs stay."""
    w = Window.partitionBy("entity_id_s1").orderBy(F.desc("score"), "entity_id_other")
    gap = F.col("score") - F.coalesce(F.lead("score").over(w), F.lit(-1.0))
    return scores.withColumns({"_place": F.row_number().over(w), "_gap": gap}).where(~((F.col("_place") == 1) & (F.col("_gap") < min_gap))).drop("_place", "_gap")


def decide(scores: DataFrame, threshold: float, *, min_gap: float | None = None, single_parent: bool = False) -> DataFrame:
    """Accepted pairs under a policy: ambiguous leaders dropped, threshold, then one parent for each other id."""
    if min_gap is not None:
        scores = drop_ambiguous_top1(scores, min_gap)
    out = accepted(scores, threshold)
    return one_parent(out) if single_parent else out


def match_lists(pairs: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """source1_entity_id, matched_entity_ids: sorted, comma-joined; with a universe, entities without a match have an empty list."""
    lists = pairs.groupBy(F.col("entity_id_s1").alias("source1_entity_id")).agg(F.array_join(F.array_sort(F.collect_set("entity_id_other")), ",").alias("matched_entity_ids"))
    if universe is None:
        return lists
    all_ids = universe.select(F.col("entity_id").alias("source1_entity_id")).distinct()
    return all_ids.join(lists, "source1_entity_id", "left").select("source1_entity_id", F.coalesce("matched_entity_ids", F.lit("")).alias("matched_entity_ids"))


def entity_scores(pred: DataFrame, truth: DataFrame, universe: DataFrame, *by: str) -> DataFrame:
    """source1_id, n_true, n_pred, n_tp, precision, recall, f05 of every entity of universe (entity_id), within each value of by.

    Nothing predicted and nothing true is perfect; predicted without truth scores 0. by names columns of pred, and of
    universe.
    """
    p = pred.select(*by, *PAIR).distinct()
    t = truth.select(*PAIR).distinct()
    preds = p.groupBy(*by, "entity_id_s1").agg(F.count("*").alias("n_pred"))
    hits = p.join(t, PAIR).groupBy(*by, "entity_id_s1").agg(F.count("*").alias("n_tp"))
    trues = t.groupBy("entity_id_s1").agg(F.count("*").alias("n_true"))
    d = universe.select(*by, F.col("entity_id").alias("entity_id_s1")).distinct()
    d = d.join(trues, "entity_id_s1", "left").join(preds, [*by, "entity_id_s1"], "left").join(hits, [*by, "entity_id_s1"], "left").fillna(0, ["n_true", "n_pred", "n_tp"])
    none = (F.col("n_pred") == 0) & (F.col("n_true") == 0)
    precision = F.when(none, 1.0).when(F.col("n_pred") == 0, 0.0).otherwise(F.col("n_tp") / F.col("n_pred"))
    recall = F.when(none, 1.0).when((F.col("n_true") == 0) | (F.col("n_pred") == 0), 0.0).otherwise(F.col("n_tp") / F.col("n_true"))
    d = d.withColumns({"precision": precision, "recall": recall})
    down = 0.25 * F.col("precision") + F.col("recall")
    f05 = F.when(down > 0, 1.25 * F.col("precision") * F.col("recall") / down).otherwise(0.0)
    return d.select(*by, F.col("entity_id_s1").alias("source1_id"), "n_true", "n_pred", "n_tp", "precision", "recall", f05.alias("f05"))


def macro(entities: DataFrame, *by: str) -> DataFrame:
    """Means over entities, and the share of entities without truth that have no prediction (null where there is none)."""
    single = F.col("n_true") == 0
    return entities.groupBy(*by).agg(
        F.round(F.avg("f05"), 6).alias("macro_f05"),
        F.round(F.avg("precision"), 6).alias("macro_precision"),
        F.round(F.avg("recall"), 6).alias("macro_recall"),
        F.round(F.avg(F.when(single, (F.col("n_pred") == 0).cast("int"))), 6).alias("singleton_accuracy"),
        F.count("*").alias("n_entities"),
    )


def pair_metrics(pred: DataFrame, truth: DataFrame) -> DataFrame:
    """tp, fp, fn, pair_precision, pair_recall, pair_f1 over pairs; null on an empty denominator."""
    p = pred.select(*PAIR).distinct().withColumn("p", F.lit(1))
    t = truth.select(*PAIR).distinct().withColumn("t", F.lit(1))
    c = p.join(t, PAIR, "full").agg(F.coalesce(F.count(F.expr("case when p = 1 and t = 1 then 1 end")), F.lit(0)).alias("tp"), F.count(F.expr("case when t is null then 1 end")).alias("fp"), F.count(F.expr("case when p is null then 1 end")).alias("fn"))
    precision, recall = F.when(F.expr("tp + fp > 0"), F.expr("tp / (tp + fp)")), F.when(F.expr("tp + fn > 0"), F.expr("tp / (tp + fn)"))
    c = c.withColumns({"pair_precision": precision, "pair_recall": recall})
    return c.withColumn("pair_f1", F.expr("case when pair_precision + pair_recall > 0 then 2 * pair_precision * pair_recall / (pair_precision + pair_recall) end"))


def threshold_table(scores: DataFrame, truth: DataFrame, universe: DataFrame, grid=COARSE, *, single_parent: bool = False) -> DataFrame:
    """One row a threshold with entity and pair metrics, from one pass: each pair is accepted by a prefix of the grid."""
    spark = scores.sparkSession
    levels = F.broadcast(spark.createDataFrame([(float(t),) for t in grid], "threshold double"))  # the grid's own length bounds it
    pred = scores.select(*PAIR, "score", F.explode(F.filter(F.array(*map(F.lit, map(float, grid))), lambda t: t <= F.col("score"))).alias("threshold"))
    if single_parent:
        pred = one_parent(pred, "threshold")
    everyone = universe.select("entity_id").distinct().join(levels)
    e = entity_scores(pred, truth, everyone, "threshold")
    sums = e.groupBy("threshold").agg(F.sum("n_tp").alias("tp"), F.sum("n_pred").alias("pred"), F.sum("n_true").alias("true"))
    sums = sums.select("threshold", F.round(F.when(F.col("pred") > 0, F.col("tp") / F.col("pred")), 6).alias("pair_precision"), F.round(F.when(F.col("true") > 0, F.col("tp") / F.col("true")), 6).alias("pair_recall"), F.col("pred").alias("n_pred"))
    out = macro(e, "threshold").join(sums, "threshold")
    return out.withColumn("avg_predicted_matches", F.round(F.col("n_pred") / F.col("n_entities"), 6)).drop("n_pred", "n_entities")


def best_threshold(table: DataFrame) -> float:
    """The lowest threshold of the best macro F0.5."""
    return table.orderBy(F.desc("macro_f05"), "threshold").first().threshold


def fine_grid(best: float, span: float = 0.05, step: float = 0.01) -> tuple[float, ...]:
    """Levels around a threshold, within 0 and 1."""
    low, high = max(0.0, best - span), min(1.0, best + span)
    return tuple(round(low + i * step, 3) for i in range(int((high + step / 2 - low) / step - 1e-9) + 1))


def source_thresholds(scores: DataFrame, truth: DataFrame, universe: DataFrame, overall: float, *, min_pairs: int = 500) -> dict[str, float]:
    """A threshold for each other source with min_pairs scored pairs or more, else the overall one. Recall counts the truth of both."""
    # The scores are made once: counted whole, and kept where a threshold can accept them.
    names, seen = {"source2": "S2-", "source3": "S3-"}, Observation()
    of = lambda prefix: F.col("entity_id_other").startswith(prefix)
    counts = [F.count(F.when(of(prefix), 1)).alias(source) for source, prefix in names.items()]
    kept = scores.select(*PAIR, "score").observe(seen, *counts).where(F.col("score") >= min(BY_SOURCE)).persist()
    kept.count()
    out = {source: best_threshold(threshold_table(kept.where(of(prefix)), truth, universe, BY_SOURCE)) if seen.get[source] >= min_pairs else overall for source, prefix in names.items()}
    kept.unpersist()
    return out


def candidate_recall(candidates: DataFrame, truth: DataFrame, universe: DataFrame) -> DataFrame:
    """n_true, n_found, recall of truth pairs of the universe's entities; recall is null without any."""
    t = truth.select(*PAIR).distinct().join(universe.select(F.col("entity_id").alias("entity_id_s1")), "entity_id_s1", "left_semi")
    found = t.join(candidates.select(*PAIR).distinct().withColumn("hit", F.lit(1)), PAIR, "left").agg(F.count("*").alias("n_true"), F.count("hit").alias("n_found"))
    return found.withColumn("recall", F.when(F.col("n_true") > 0, F.round(F.col("n_found") / F.col("n_true"), 6)))


def labels(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """Candidates with label 1 where truth has the pair, else 0."""
    t = truth.select(*PAIR).distinct().withColumn("label", F.lit(1))
    return candidates.join(t, PAIR, "left").fillna(0, ["label"])


def outside_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """Matches that were no candidates."""
    return matches.select(*PAIR).distinct().join(candidates, PAIR, "left_anti")
