"""Seeded samples and splits of entities by hash order, the same on every cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def order(seed: int | str, id_col: str = "entity_id") -> Column:
    """The sampling order: a hash that other engines share."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col)))


def sample(ids: DataFrame, n: int, seed: int | str = 42) -> DataFrame:
    """n ids without replacement; all of them where n is 0 or less, or not less than their number."""
    return ids if n <= 0 else ids.orderBy(order(seed), "entity_id").limit(n)


def split(ids: DataFrame, fraction: float = 0.25, seed: int | str = 42) -> DataFrame:
    """entity_id, part: the first floor(n * fraction) ids in seeded order are 'validation', the others 'train'.

    The cut is found by ranking ranges of the hash, then ids inside the one range that holds it: no task ranks all ids.
    """
    d = ids.select("entity_id").withColumn("h", order(seed)).withColumn("range", F.substring("h", 1, 3))
    sums = d.groupBy("range").agg(F.count("*").alias("n"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    edges = sums.withColumns({"before": F.coalesce(F.sum("n").over(upto), F.lit(0)), "wanted": F.floor(F.sum("n").over(Window.partitionBy()) * fraction)})
    d = d.join(F.broadcast(edges.select("range", "before", "wanted")), "range")  # 4096 ranges at most
    inside = F.row_number().over(Window.partitionBy("range").orderBy("h", "entity_id"))
    return d.withColumn("place", F.col("before") + inside).select("entity_id", F.when(F.col("place") <= F.col("wanted"), "validation").otherwise("train").alias("part"))


def background(ids: DataFrame, exclude: DataFrame, n: int, seed: int | str = 42) -> DataFrame:
    """n ids that are not excluded."""
    return sample(ids.join(exclude.select("entity_id"), "entity_id", "left_anti"), n, seed)


def training_pool(left: DataFrame, sources: dict[str, DataFrame], truth: DataFrame, *, multiplier: float = 5.0, size: int | None = None, seed: int = 42) -> dict[str, DataFrame]:
    """For each source its rows that truth matches with left, and background rows: size of them, by default max(matches, rows of left * multiplier)."""
    wanted = truth.join(left.select(F.col("entity_id").alias("entity_id_s1")), "entity_id_s1", "left_semi").select(F.col("entity_id_other").alias("entity_id")).distinct()
    n_left, out = left.count(), {}
    for k, (name, rows) in enumerate(sources.items()):
        true = rows.join(wanted, "entity_id", "left_semi")
        n = max(true.count(), int(n_left * multiplier)) if size is None else size
        out[name] = true.unionByName(rows.join(background(rows.select("entity_id"), true, n, seed + k), "entity_id", "left_semi")) if n > 0 else true
    return out
