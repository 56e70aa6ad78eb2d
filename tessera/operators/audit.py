"""Counts and profiles of the input tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """name, n_rows of each table."""
    return reduce(DataFrame.union, (d.agg(F.lit(k).alias("name"), F.count("*").alias("n_rows")).select("name", "n_rows") for k, d in tables.items()))


def profile(table: DataFrame) -> DataFrame:
    """One row: rows, distinct ids, names and addresses, share of empty fields, mean lengths."""
    empty = lambda c: F.round(F.avg((F.coalesce(c, F.lit("")) == "").cast("int")), 6)
    return table.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("entity_id").alias("n_ids"),
        F.countDistinct("business_name").alias("n_names"),
        F.countDistinct("business_address").alias("n_addresses"),
        empty("business_name").alias("empty_names"),
        empty("business_address").alias("empty_addresses"),
        F.round(F.avg(F.length("business_name")), 6).alias("mean_name_length"),
        F.round(F.avg(F.length("business_address")), 6).alias("mean_address_length"),
    )


def country_counts(table: DataFrame) -> DataFrame:
    return table.groupBy("country").agg(F.count("*").alias("n"))


def match_histogram(truth: DataFrame, universe: DataFrame) -> DataFrame:
    """n_matches, n_entities over all entities of the universe."""
    each = universe.select(F.col("entity_id").alias("entity_id_s1")).join(truth.select("entity_id_s1", "entity_id_other").distinct(), "entity_id_s1", "left").groupBy("entity_id_s1").agg(F.count("entity_id_other").alias("n_matches"))
    return each.groupBy("n_matches").agg(F.count("*").alias("n_entities"))


def fan_in(truth: DataFrame) -> DataFrame:
    """n_parents, n_ids: how many entities claim a matched id."""
    return truth.groupBy("entity_id_other").agg(F.countDistinct("entity_id_s1").alias("n_parents")).groupBy("n_parents").agg(F.count("*").alias("n_ids"))


def separation(labelled: DataFrame, features: list[str], top: int = 20) -> DataFrame:
    """feature, mean_match, mean_other, gap of the features whose means differ most between labels."""
    means = labelled.groupBy("label").agg(*(F.avg(F.col(c).cast("double")).alias(c) for c in features)).unpivot("label", features, "feature", "mean")
    both = means.groupBy("feature").agg(F.max(F.when(F.col("label") == 1, F.round("mean", 6))).alias("mean_match"), F.max(F.when(F.col("label") == 0, F.round("mean", 6))).alias("mean_other"))
    return both.withColumn("gap", F.round(F.abs(F.col("mean_match") - F.col("mean_other")), 6)).orderBy(F.desc("gap"), "feature").limit(top)


def worst(entities: DataFrame, n: int = 20) -> DataFrame:
    """The n entities of the lowest f05."""
    return entities.orderBy("f05", "source1_id").limit(n)
