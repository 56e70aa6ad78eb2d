"""Checks of result tables and files: each violation is a row (check, id)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

HEADERS = {"matching": ["source1_entity_id", "matched_entity_ids"], "candidates": ["source1_entity_id", "candidate_entity_ids"]}


class OutputFormatError(ValueError):
    pass


def violations(results: DataFrame, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """check, id of every offence in results (source1_entity_id, and a second column of comma-joined ids).

    Rows must be one for each required entity_id, lists without repeats, and list ids S2 or S3 ids that are known
    (not checked without known). A blank list has no ids; an empty place in another is an id without a prefix.
    """
    ids = F.coalesce("ids", F.lit(""))
    d = results.toDF("s1", "ids").withColumn("list", F.when(F.trim(ids) != "", F.split(ids, ",")).otherwise(F.array().cast("array<string>")))
    item = d.select(F.explode("list").alias("id")).distinct()
    need, seen = required.select(F.col("entity_id").alias("id")).distinct(), d.select(F.col("s1").alias("id")).distinct()
    foreign = ~F.col("id").startswith("S1-") & ~F.col("id").startswith("S2-") & ~F.col("id").startswith("S3-")
    found = {
        "duplicate_row": d.groupBy(F.col("s1").alias("id")).count().where("count > 1").select("id"),
        "repeated_id": d.where(F.size("list") > F.size(F.array_distinct("list"))).select(F.col("s1").alias("id")).distinct(),
        "self_match": item.where(F.col("id").startswith("S1-")),
        "wrong_prefix": item.where(foreign),
        "missing_row": need.join(seen, "id", "left_anti"),
        "extra_row": seen.join(need, "id", "left_anti"),
    }
    if known is not None:
        listed = item.where(F.col("id").startswith("S2-") | F.col("id").startswith("S3-"))
        found["unknown_id"] = listed.join(known.select(F.col("entity_id").alias("id")), "id", "left_anti")
    return reduce(DataFrame.union, (v.select(F.lit(k).alias("check"), "id") for k, v in found.items()))


def output_frame(pairs: DataFrame, required: DataFrame, list_column: str = "matched_entity_ids") -> DataFrame:
    """One row for each required entity, lists sorted; fails on repeated required ids and on ids of another kind."""
    from tessera.operators.decide import match_lists

    if required.groupBy("entity_id").count().where("count > 1").limit(1).count():
        raise OutputFormatError("required ids repeat")
    odd = pairs.where(~F.col("entity_id_other").startswith("S2-") & ~F.col("entity_id_other").startswith("S3-"))
    if odd.limit(1).count():
        raise OutputFormatError("a list holds an id that is neither of source 2 nor of source 3")
    return match_lists(pairs, required).withColumnRenamed("matched_entity_ids", list_column)


def file_problems(spark: SparkSession, path: str, kind: str) -> list[str]:
    """What is wrong with a result file as text: absence, emptiness, commas for tabs, another header, rows without a tab."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return [f"not found: {path}"]
    lines = spark.read.text(path)
    head = lines.first()
    if head is None or not head.value:
        return [f"empty: {path}"]
    if "\t" not in head.value and "," in head.value:
        return [f"comma-separated, not tab-separated: {path}"]
    names = [c.strip().lower() for c in head.value.split("\t")]
    if names != HEADERS[kind]:
        return [f"header {names}, expected {HEADERS[kind]}: {path}"]
    bad = [r.value for r in lines.where(~F.col("value").contains("\t") & (F.trim("value") != "")).limit(5).collect()]
    return [f"no tab in row {b!r}: {path}" for b in bad]


def validate(spark: SparkSession, matching: str, candidates: str | None, required: DataFrame, known: DataFrame | None = None) -> tuple[list[str], list[str]]:
    """Errors and warnings of the result files; matches that were no candidates are warnings."""
    from tessera.sources.files import read_results

    errors, tables = [], {}
    for kind, path in (("matching", matching), ("candidates", candidates)):
        if path is None:
            continue
        problems = file_problems(spark, path, kind)
        errors += problems
        if not problems:
            tables[kind] = read_results(spark, path)
            errors += [f"{kind}: {r.check}: {r.n}, such as {r.one}" for r in violations(tables[kind], required, known).groupBy("check").agg(F.count("*").alias("n"), F.min("id").alias("one")).orderBy("check").collect()]
    warnings = []
    if len(tables) == 2:
        pairs = {k: t.toDF("entity_id_s1", "ids").select("entity_id_s1", F.explode(F.split("ids", ",")).alias("entity_id_other")).where("entity_id_other <> ''") for k, t in tables.items()}
        n = pairs["matching"].join(pairs["candidates"], ["entity_id_s1", "entity_id_other"], "left_anti").count()
        warnings = [f"{n} matches are no candidates"] if n else []
    return errors, warnings
