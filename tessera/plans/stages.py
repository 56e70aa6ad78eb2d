"""The stages of a run over stored tables: audit, prepare, train, infer, validate. Each returns what it found as a dict."""

from __future__ import annotations

import resource
import time
import uuid
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.operators import decide, sampling, validate as checks
from tessera.operators.models import PairModel
from tessera.plans.pipeline import Settings, Trained, scored, train as fit
from tessera.sources import files


@dataclass
class Run:
    """Where a run reads and writes, and how it decides. Values from a JSON file, then from name=value words."""

    raw: str = "data/raw"
    cache: str = "data/cache"
    model: str = "data/model"
    out: str = "data/out"
    split: str = "test"
    sample: int | None = None
    min_gap: float | None = None
    single_parent: bool = False
    settings: Settings = field(default_factory=Settings)

    @classmethod
    def of(cls, given: dict, words: list[str] = ()) -> Run:
        """Names of either class; a word's value is read as its field's present kind."""
        run = cls()
        own, inner = ({f.name for f in fields(c)} - {"settings"} for c in (cls, Settings))
        for name, value in [*given.items(), *(w.split("=", 1) for w in words)]:
            at = run if name in own else run.settings if name in inner else None
            if at is None:
                raise ValueError(f"unknown setting {name}")
            setattr(at, name, _as(getattr(at, name), name, value))
        return run


def _as(old, name: str, value):
    if not isinstance(value, str) or isinstance(old, str):
        return value
    if value.lower() in ("none", "null", ""):
        return None
    if isinstance(old, bool):
        if value.lower() not in ("true", "false", "1", "0", "yes", "no"):
            raise ValueError(f"{name}: {value} is neither true nor false")
        return value.lower() in ("true", "1", "yes")
    if isinstance(old, list):
        return value.split(",")
    return float(value) if name == "min_gap" or isinstance(old, float) else int(value)


def test_sample(left: DataFrame, run: Run) -> DataFrame:
    """The left records that a run links: all, or a seeded sample of the test split."""
    if run.sample is None:
        return left
    n = left.count()
    if run.split != "test" or not 1 <= run.sample <= n:
        raise ValueError(f"a sample needs the test split and 1 to {n} records, not {run.split} and {run.sample}")
    ids = sampling.sample(left.select("entity_id"), run.sample, run.settings.seed)
    return left.join(ids, "entity_id", "left_semi")


def _sides(store: files.Store, split: str) -> tuple[DataFrame, DataFrame]:
    return store.source(split, 1), store.source(split, 2).unionByName(store.source(split, 3))


def audit(spark: SparkSession, run: Run) -> dict:
    return files.Store(spark, run.raw, run.cache).audit()


def prepare(spark: SparkSession, run: Run) -> dict:
    store = files.Store(spark, run.raw, run.cache)
    store.build_all()
    return {"ok": True}


def train(spark: SparkSession, run: Run) -> dict:
    store = files.Store(spark, run.raw, run.cache)
    truth = store.truth_pairs()
    t = fit(*_sides(store, "train"), truth.toDF("entity_id_s1", "entity_id_other"), run.settings)
    t.save(run.model)
    files.append_experiments(spark, f"{run.out}/experiments", spark.createDataFrame([{k: v for k, v in r.items() if v is not None} for r in t.results]))
    return {"ok": True, "model": t.model.name, "threshold": t.threshold, "results": t.results}


def infer(spark: SparkSession, run: Run) -> dict:
    """Writes matching_results and candidate_pairs of a split; every left record has a row in both."""
    store, t = files.Store(spark, run.raw, run.cache), Trained.load(spark, run.model)
    left, right = _sides(store, run.split)
    left = test_sample(left, run)
    scores = scored(left, right, t.model, t.settings, t.idf).persist()
    matches = decide.decide(scores, t.threshold, min_gap=run.min_gap, single_parent=run.single_parent)
    files.write_results(checks.output_frame(matches, left), f"{run.out}/matching_results")
    files.write_results(checks.output_frame(scores, left, "candidate_entity_ids"), f"{run.out}/candidate_pairs")
    found = {"ok": True, "entities": left.count(), "candidates": scores.count(), "matches": matches.count()}
    scores.unpersist()
    return found


def validate(spark: SparkSession, run: Run) -> dict:
    store = files.Store(spark, run.raw, run.cache)
    left, right = _sides(store, run.split)
    required = test_sample(left, run).select("entity_id")
    errors, warnings = checks.validate(spark, f"{run.out}/matching_results", f"{run.out}/candidate_pairs", required, right.select("entity_id"))
    return {"ok": not errors, "errors": errors, "warnings": warnings}


STAGES = {"audit": audit, "prepare": prepare, "train": train, "infer": infer, "validate": validate}


def run_stages(spark: SparkSession, names: list[str], run: Run) -> list[dict]:
    """Runs stages in order until one is not ok; a report for each, kept below out/reports by run id."""
    run_id, reports = uuid.uuid4().hex[:12], []
    for name in names:
        began = time.perf_counter()
        found = STAGES[name](spark, run)
        reports.append({"run": run_id, "stage": name, "seconds": round(time.perf_counter() - began, 3), "driver_peak_mb": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024, "cores": spark.sparkContext.defaultParallelism, "spark": spark.version, **found})
        if not found["ok"]:
            break
    files.write_json(spark, f"{run.out}/reports/{run_id}.json", reports)
    return reports


def map_chunks(df: DataFrame, function, schema: str) -> DataFrame:
    """df through a function from pandas frame to pandas frame, an Arrow batch of rows at a time."""

    def run(frames):
        for frame in frames:
            yield function(frame)

    return df.mapInPandas(run, schema)
