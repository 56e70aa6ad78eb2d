import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import pairs as P, similarity as S, text as T
from tessera.operators import blocking, decide, sampling, validate


def records(spark, rows):
    return T.normalized(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"))


def test_normalisation(spark):
    rows = [("S1-0", "B+ Retail, Inc", "12 Rue, 75001", "FR"), ("S1-1", "A & B", "123456 then 654321", None), ("S1-2", "Orelee's  Barbershop", "12 34", " us "), ("S1-3", None, None, ""), ("S1-4", "Ｇｏ１２ inc ltd", "", "x"), ("S1-5", "inc ltd", "", "x"), ("S1-6", "इंडिया inc", "", "in")]
    d = {r.entity_id: r for r in records(spark, rows).collect()}
    assert (d["S1-0"].name_alnum, d["S1-0"].name_core, d["S1-0"].address_postal) == ("b retail inc", "b retail", "75001")
    assert d["S1-1"].name_norm == "a and b" and d["S1-1"].address_postal == "123456" and d["S1-1"].country_norm == ""
    assert d["S1-2"].name_norm == "orelees barbershop" and d["S1-2"].address_postal == "" and d["S1-2"].country_norm == "us"
    assert d["S1-3"].name_tokens == [] and d["S1-3"].name_first_token == ""
    assert d["S1-4"].name_norm == "go12 inc ltd" and d["S1-4"].name_numbers == ["12"]
    assert d["S1-5"].name_core == ""
    assert d["S1-6"].name_alnum == "इ ड य inc"


def test_pair_functions(spark):
    rows = [(["a", "b"], ["b", "a", "a"], ["1", "2"], ["2", "1"]), ([], [], [], []), (["a"], [], ["1"], ["1"])]
    d = spark.createDataFrame(rows, "a array<string>, b array<string>, x array<string>, y array<string>")
    got = d.select(P.jaccard(F.col("a"), F.col("b")), P.common_count(F.col("a"), F.col("b")), P.same_items(F.col("x"), F.col("y")), P.same_sequence(F.col("x"), F.col("y"))).collect()
    assert [tuple(r) for r in got] == [(1.0, 2, 1, 0), (1.0, 0, 0, 0), (0.0, 0, 1, 1)]


def test_similarities_by_definition():
    rng = random.Random(1)

    def lcs(a, b):
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
        return d[-1][-1]

    for _ in range(300):
        a, b = ("".join(rng.choice("abc d") for _ in range(rng.randint(0, n))) for n in (10, 16))
        assert S.lcs(a, b) == lcs(a, b)
        if a and b and len(a) != len(b):
            s, l = sorted((a, b), key=len)
            best = max(S.ratio(s, l[max(0, e - len(s)) : min(e, len(l))]) for e in range(1, len(l) + len(s)))
            assert S.partial_ratio(a, b) == pytest.approx(best)
    assert S.ratio("", "") == 1 and S.partial_ratio("", "x") == 0 and S.token_set_ratio("", "a") == 0
    assert S.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert S.token_sort_ratio("b a", "a b") == 1 and S.token_set_ratio("a b c", "b a") == 1


def test_blocking_caps(spark):
    left = records(spark, [(f"S1-{i}", "same name", "", "us") for i in range(3)] + [("S1-9", "rare rare", "", "fr")])
    right = records(spark, [(f"S2-{i}", "same name", "", "us") for i in range(2)] + [("S2-9", "rare other", "", "fr"), ("S2-8", "", "", "us")])
    count = lambda cap, rule: blocking.pairs_by_rule(left, right, rules=[rule], max_block=cap).count()
    assert count(3, "exact_name") == 6 and count(2, "exact_name") == 0
    assert count(2, "rare_name_token") == 1 and count(1, "rare_name_token") == 0  # the token stands twice on the left
    assert {r.rule for r in blocking.pairs_by_rule(left, right, max_block=10).collect()} >= {"exact_name", "address_number_country", "rare_name_token"}


def test_f05_and_policies(spark):
    pairs = lambda rows: spark.createDataFrame(rows, "entity_id_s1 string, entity_id_other string")
    uni = spark.createDataFrame([(f"S1-{i}",) for i in range(4)], "entity_id string")
    pred = pairs([("S1-0", "S2-1"), ("S1-0", "S2-2"), ("S1-0", "S3-3"), ("S1-2", "S2-9")])
    truth = pairs([("S1-0", "S2-1"), ("S1-0", "S3-3"), ("S1-3", "S2-5")])
    e = {r.source1_id: (round(r.precision, 6), r.recall, round(r.f05, 6)) for r in decide.entity_scores(pred, truth, uni).collect()}
    assert e == {"S1-0": (0.666667, 1.0, 0.714286), "S1-1": (1, 1, 1), "S1-2": (0, 0, 0), "S1-3": (0, 0, 0)}
    scores = spark.createDataFrame([("S1-0", "S2-1", 0.9), ("S1-0", "S2-2", 0.9), ("S1-1", "S2-1", 0.9), ("S1-2", "S2-7", 0.5)], "entity_id_s1 string, entity_id_other string, score double")
    ids = lambda d: sorted((r.entity_id_s1, r.entity_id_other) for r in d.collect())
    assert ids(decide.decide(scores, 0.5)) == sorted([("S1-0", "S2-1"), ("S1-0", "S2-2"), ("S1-1", "S2-1"), ("S1-2", "S2-7")])
    assert ids(decide.one_parent(scores)) == [("S1-0", "S2-1"), ("S1-0", "S2-2"), ("S1-2", "S2-7")]
    assert ids(decide.drop_ambiguous_top1(scores, 0.1)) == [("S1-0", "S2-2"), ("S1-1", "S2-1"), ("S1-2", "S2-7")]
    assert decide.fine_grid(0.95) == tuple(round(0.9 + 0.01 * i, 3) for i in range(11))


def test_validator_and_split(spark):
    res = spark.createDataFrame([("S1-0", "S2-1,S2-1"), ("S1-0", "S1-4,Q-1"), ("S1-7", "S3-99,"), ("S1-1", " ")], "a string, b string")
    uni = spark.createDataFrame([("S1-0",), ("S1-1",)], "entity_id string")
    got = {(r.check, r.id) for r in validate.violations(res, uni, spark.createDataFrame([("S2-1",)], "entity_id string")).collect()}
    assert got == {("duplicate_row", "S1-0"), ("repeated_id", "S1-0"), ("self_match", "S1-4"), ("wrong_prefix", "Q-1"), ("unknown_id", "S3-99"), ("wrong_prefix", ""), ("extra_row", "S1-7")}
    ids = spark.range(101).selectExpr("concat('S1-', id) as entity_id")
    assert sampling.split(ids, 0.25).where("part = 'validation'").count() == 25


def test_files(spark, tmp_path):
    from tessera.sources import files

    raw = tmp_path / "raw" / "train"
    raw.mkdir(parents=True)
    for k in (1, 2, 3):
        (raw / f"train_source{k}.tsv").write_text(f'entity_id\tbusiness_name\tbusiness_address\tcountry\nS{k}-1\t"A ""q"" B"\t\tNA\n')
    (raw / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\n")
    store = files.Store(spark, str(tmp_path / "raw"), str(tmp_path / "cache"))
    store.build_all(["train"])
    assert tuple(store.source("train", 1).first()) == ("S1-1", 'A "q" B', "", "NA")
    assert store.truth_pairs().count() == 2 and store.audit(["train"])["ok"] and not store.audit(["test"])["ok"]
    (raw / "train_source1.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n")
    assert store.source("train", 1).count() == 0  # a changed file is read again


def test_train_and_link(spark, tmp_path):
    from tessera.plans.pipeline import Settings, Trained, train

    rng = random.Random(2)
    words = ["alpha", "river", "stone", "green", "market", "north", "cedar", "bridge"]
    left, right, truth = [], [], []
    for i in range(24):
        name, addr = " ".join(rng.sample(words, 3)) + f" {i}", f"{i + 10} main street {10000 + i}"
        left.append((f"S1-{i}", name, addr, "us"))
        right.append((f"S2-{i}", name.upper() + " Inc.", addr, "us"))
        truth.append((f"S1-{i}", f"S2-{i}"))
    schema = "entity_id string, business_name string, business_address string, country string"
    l, r = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    t = train(l, r, spark.createDataFrame(truth, "entity_id_s1 string, entity_id_other string"), Settings(models=["rule", "logistic"]))
    assert max(x["macro_f05"] for x in t.results) > 0.9
    t.save(str(tmp_path / "model"))
    again = Trained.load(spark, str(tmp_path / "model"))
    found = {x.source1_entity_id: x.matched_entity_ids for x in again.link(l, r).collect()}
    assert len(found) == 24 and sum(b in found[a].split(",") for a, b in truth) >= 20


def test_stream(spark, tmp_path):
    from tessera.streaming.scorer import stream_links

    schema = "entity_id string, business_name string, business_address string, country string"
    spark.createDataFrame([("S1-1", "north river", "1 a", "us")], schema).write.parquet(str(tmp_path / "in"))
    right = spark.createDataFrame([("S2-1", "north river", "1 a", "us")], schema)
    q = stream_links(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), right, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).first().matched_entity_ids == "S2-1"


def test_views_read_whole_texts(spark, tmp_path):
    from tessera.plans import entities, queries

    body = "first line, the name\n" + "same words of the rest " * 9
    texts = [(0, body + "and 75001 here"), (1, body + "and 75001 here"), (2, body + "and 99999 there, with quite another end of the text " * 4), (3, "one line only"), (4, None)]
    spark.createDataFrame([(i, t, "en") for i, t in texts], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    r = {x.entity_id: x for x in entities.records(spark, str(tmp_path)).collect()}
    assert all(f"{r[e].business_name}\n{r[e].business_address}" == texts[i][1] for i, e in ((0, "S1-0"), (1, "S2-1"), (2, "S3-2")))
    assert (r["S1-3"].business_name, r["S1-3"].business_address, r["S2-4"].business_name) == ("one line only", "", None)
    title, end = "a title with many words in it " * 9, "that no other has"
    pages = [(0, "http://a.example/75001", title + "and one"), (1, "http://a.example/75001", title + "and one"), (2, "http://a.example/75001", title + "and another end " + end * 9), (3, None, None)]
    html = lambda t: None if t is None else f"<!DOCTYPE html>\n<html lang='en'><head><meta charset=utf-8><TITLE>{t}</TITLE></head><body>text</body></html>"
    spark.createDataFrame([(i, u, html(t)) for i, u, t in pages], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    r = {x.entity_id: x for x in entities.page_records(spark, str(tmp_path)).collect()}
    assert (r["S1-0"].business_name, r["S1-0"].business_address, r["S1-0"].country) == (title + "and one", "http://a.example/75001", "en") and r["S1-3"].business_name is None
    scores = {x.entity_id_other: x.score for x in queries.queries()["rule_score"](spark, str(tmp_path)).where("entity_id_s1 = 'S1-0'").collect()}
    assert scores["S2-1"] == 1 and scores["S3-2"] < 0.9


def test_queries_take_production_limits(spark, tmp_path, monkeypatch):
    from tessera.operators import models
    from tessera.plans import queries

    pages = [(i, f"http://place.example/{i}", "<html lang='en'><head><title>same name</title></head></html>") for i in range(75)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = queries.queries()
    assert found["rule_score"](spark, str(tmp_path)).count() == 25 * 50
    assert found["pair_fuzzy_all"](spark, str(tmp_path)).count() == 25 * 50
    assert all(len(r.matched_entity_ids.split(",")) == 50 for r in found["end_to_end"](spark, str(tmp_path)).collect())
    given = {}
    monkeypatch.setattr(models.PairModel, "fit", classmethod(lambda cls, name, table, columns, **kw: given.update({name: kw}) or cls("rule", [])))
    for name in ("forest", "boosted"):
        found[f"ml_{name}"](spark, str(tmp_path))
    assert given == {"forest": {}, "boosted": {}}


def test_top_k_by_brute_force(spark, monkeypatch):
    """Blocks of few rows give what one product of all rows gives."""
    from tessera.operators import retrieval

    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(2, 5)))
    rows = [(f"S{1 + i % 3}-{i}", " ".join(word() for _ in range(rng.randint(0, 4)))) for i in range(60)]
    texts = spark.createDataFrame(rows, "entity_id string, t string")
    idf = retrieval.fit(texts, "t").persist()
    weights = {}
    for r in retrieval.weights(texts, "entity_id", "t", idf).collect():
        weights.setdefault(r.id, {})[r.gram] = r.w
    dots = {}
    for a, x in weights.items():
        for b, y in weights.items():
            if a.startswith("S1-") and not b.startswith("S1-") and x.keys() & y.keys():
                dots.setdefault((a, b[:2]), []).append((-round(sum(w * y.get(g, 0) for g, w in x.items()), 6), b))
    want = {(a, b): -s for (a, _), found in dots.items() for s, b in sorted(found)[:3]}
    sides = [retrieval.weights(texts.where(c), "entity_id", "t", idf) for c in ("entity_id like 'S1-%'", "entity_id not like 'S1-%'")]
    for size in (1 << 19, 200):
        monkeypatch.setattr(retrieval, "BLOCK_WEIGHTS", size)
        got = {(r.entity_id_s1, r.entity_id_other): r.score for r in retrieval.top_k(*sides, 3).collect()}
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 2e-6 for p in got)


def test_limits_count_for_each_source(spark):
    from tessera.operators import retrieval

    left = records(spark, [("S1-0", "same name", "", "us")])
    right = records(spark, [(f"S{k}-{i}", "same name", "", "us") for k, n in ((2, 3), (3, 2)) for i in range(n)])
    found = lambda **kw: sorted(r.entity_id_other for r in blocking.pairs_by_rule(left, right, rules=["exact_name"], **kw).collect())
    assert found(max_block=3) == ["S2-0", "S2-1", "S2-2", "S3-0", "S3-1"] and found(max_block=2) == ["S3-0", "S3-1"]
    assert found(max_block=3, apart=False) == []
    assert {r.entity_id_other for r in blocking.pairs_by_rule(left, right, rules=["rare_name_token"], rare_limit=2).collect()} == {"S3-0", "S3-1"}
    near = lambda **kw: sorted(r.entity_id_other for r in retrieval.retrieve(left, right, "name_alnum", k=2, **kw).collect())
    assert near() == ["S2-0", "S2-1", "S3-0", "S3-1"]


def test_stages_end_to_end(spark, tmp_path, monkeypatch, capsys):
    """The command line from raw tables to checked results, a sample, and its errors."""
    import json

    from tessera import __main__ as cli
    from tessera.plans import stages

    rng = random.Random(5)
    words = ["alpha", "river", "stone", "green", "market", "north", "cedar", "bridge"]
    for split in ("train", "test"):
        d = tmp_path / "raw" / split
        d.mkdir(parents=True)
        tables = {1: [], 2: [], 3: []}
        for i in range(20):
            name, addr = " ".join(rng.sample(words, 3)) + f" {i}", f"{i + 10} main street {10000 + i}"
            for k, form in ((1, name), (2, name.upper() + " Inc."), (3, name + " ltd")):
                tables[k].append(f"S{k}-{i}\t{form}\t{addr}\tus")
        for k, rows in tables.items():
            (d / f"{split}_source{k}.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "\n".join(rows) + "\n")
    (tmp_path / "raw/train/train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\tS2-{i},S3-{i}\n" for i in range(20)))
    monkeypatch.setattr(spark, "stop", lambda: None)
    at = [f"{k}={tmp_path}/{k}" for k in ("raw", "cache", "model", "out")]
    assert cli.main(["all", *at, "models=rule", "tfidf=false", "sample=5"]) == 0
    reports = json.loads(capsys.readouterr().out)
    assert [r["stage"] for r in reports] == list(stages.STAGES) and reports[3]["entities"] == 5 and reports[4]["errors"] == []
    run = stages.Run.of({"sample": 21, "raw": str(tmp_path / "raw"), "cache": str(tmp_path / "cache")})
    with pytest.raises(ValueError, match="1 to 20"):
        stages.validate(spark, run)
    with pytest.raises(ValueError, match="test split"):
        stages.validate(spark, stages.Run.of({"sample": 2, "split": "train", "raw": run.raw, "cache": run.cache}))
    with pytest.raises(ValueError, match="unknown setting"):
        stages.Run.of({}, ["sampel=2"])
    assert cli.main(["audit", f"raw={tmp_path}/none", *at[1:]]) == 1
    assert stages.map_chunks(spark.range(5).toDF("x"), lambda f: f.assign(x=f.x + 1), "x long").selectExpr("sum(x) as s").first().s == 15


def test_index_is_reused(spark, tmp_path):
    from tessera.sources.index import BlockingIndex

    left = records(spark, [("S1-0", "same name", "1 a", "us"), ("S1-1", "other words", "2 b", "fr")])
    right = records(spark, [(f"S{k}-{i}", n, a, c) for k in (2, 3) for i, (n, a, c) in enumerate([("same name", "1 a", "us"), ("same name", "9 z", "us"), ("other", "2 b", "fr")])])
    index = BlockingIndex(spark, str(tmp_path / "i"))
    with pytest.raises(FileNotFoundError):
        index.postings()
    assert index.build(right, {"v": 1}) and not index.build(right, {"v": 1})
    for kw in ({}, {"max_block": 1}, {"scope": "country_norm"}):
        assert sorted(map(tuple, index.pairs(left, **kw).collect())) == sorted(map(tuple, blocking.pairs_by_rule(left, right, **kw).collect()))
    assert index.build(right.limit(0), {"v": 2}) and index.pairs(left).count() == 0


def test_sinks_and_checks(spark, tmp_path):
    from tessera.sources import files

    lists = spark.createDataFrame([("S1-0", "S2-1,S3-2"), ("S1-1", "")], "source1_entity_id string, matched_entity_ids string")
    path, uni = str(tmp_path / "res"), spark.createDataFrame([("S1-0",), ("S1-1",), ("S1-2",)], "entity_id string")
    files.write_results(lists, path)
    files.append_results(spark.createDataFrame([("S1-2", "S3-9")], lists.schema), path)
    assert {tuple(r) for r in files.read_results(spark, path).collect()} == {("S1-0", "S2-1,S3-2"), ("S1-1", ""), ("S1-2", "S3-9")}
    for bad in ("S2-1,", "S1-4", "Q-1", "S2-1,S2-1"):
        with pytest.raises(validate.OutputFormatError):
            files.append_results(spark.createDataFrame([("S1-3", bad)], lists.schema), path)
    assert validate.file_problems(spark, path, "matching") == [] and validate.validate(spark, path, None, uni) == ([], [])
    assert "not found" in validate.file_problems(spark, str(tmp_path / "none"), "matching")[0]
    for text, said in (("", "empty"), ("source1_entity_id,matched_entity_ids\n", "comma"), ("a\tb\n", "header"), ("source1_entity_id\tmatched_entity_ids\nS1-1\n", "no tab")):
        (tmp_path / "f.tsv").write_text(text)
        assert said in validate.file_problems(spark, str(tmp_path / "f.tsv"), "matching")[0]
    (tmp_path / "ids.tsv").write_text("entity_id\tx\n S1-1 \t2\n\t3\nS1-1\t4\n")
    assert [r.entity_id for r in files.read_ids(spark, str(tmp_path / "ids.tsv")).collect()] == ["S1-1"]
    log = str(tmp_path / "log")
    files.append_experiments(spark, log, spark.createDataFrame([(1, "a")], "x int, y string"))
    assert sorted(map(str, files.append_experiments(spark, log, spark.createDataFrame([(2, 0.5)], "x int, z double")).select("x", "y", "z").collect())) == ["Row(x=1, y='a', z=None)", "Row(x=2, y=None, z=0.5)"]


def test_overlaps_by_brute_force(spark, monkeypatch):
    """Sets meet in cells, whatever their number, and a pair's row carries no set."""
    from tessera.operators import features

    rng = random.Random(11)
    side = lambda s, n: [(f"{s}-{i}", sorted(rng.sample(range(40), rng.randint(0, 12))), i) for i in range(n)]
    l, r = side("S1", 30), side("S2", 50)
    pairs = [(a[0], b[0]) for a in l for b in r if rng.random() < 0.3]
    frame = lambda rows: spark.createDataFrame([(i, s, [x / 8 for x in s], n) for i, s, n in rows], "entity_id string, s array<long>, v array<double>, n int")
    sets, numbers = ({i: x[k] for x in (*l, *r) for i in [x[0]]} for k in (1, 2))
    for items in (1 << 21, 60):
        monkeypatch.setattr(features, "CELL_ITEMS", items)
        given = spark.createDataFrame(pairs, "entity_id_s1 string, entity_id_other string")
        got = features.overlaps(given, frame(l), frame(r), ["s"], numbers=["n"]).collect()
        assert sorted(map(tuple, got)) == sorted((a, b, len({*sets[a]} & {*sets[b]}), numbers[a], numbers[b]) for a, b in pairs)
        got = features.overlaps(given, frame(l), frame(r), ["s"], weights="v").collect()
        assert sorted(map(tuple, got)) == sorted((a, b, sum({*sets[a]} & {*sets[b]}) / 8) for a, b in pairs)


def test_pair_queries_carry_no_texts(spark):
    """Nothing that is shuffled for a candidate pair or kept for a key grows with the texts: whole addresses are keys by digest."""
    from tessera.operators import blocking

    rec = lambda i: (i, "n", "n", ["n"], "n", "a" * 5000 + i[-1], "1", "c")
    d = spark.createDataFrame([rec("S1-1"), rec("S2-1"), rec("S2-2")], "entity_id string, name_norm string, name_compact string, name_tokens array<string>, name_first_token string, address_norm string, address_first_number string, country_norm string")
    left, right = d.where("entity_id like 'S1%'"), d.where("entity_id like 'S2%'")
    assert [r.entity_id_other for r in blocking.pairs_by_rule(left, right, rules=["exact_address"]).collect()] == ["S2-1"]
    l, r = (blocking.postings(x, ["exact_address"]) for x in (left, right))
    met = blocking._met(l, r.withColumn("source", blocking.source_of("entity_id")))
    assert max(len(x.key) for x in met.collect()) == 33


def test_retrieval_shuffles_no_weights(spark, monkeypatch):
    """Blocks, slices and the dense part of any size give what the products of weights give; only the k best rows are shuffled."""
    from tessera.operators import retrieval

    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    rows = [(f"S{1 + i % 3}-{i}", " ".join(word() for _ in range(rng.randint(0, 5)))) for i in range(60)] + [("S2-900", "same words"), ("S2-1000", "same words"), ("S1-901", "same words"), ("S1-902", None)]
    d = spark.createDataFrame(rows, "entity_id string, name_alnum string")
    left, right = d.where("entity_id like 'S1-%'"), d.where("entity_id not like 'S1-%'")
    idf = retrieval.fit(d, "name_alnum").persist()
    want = {(r.entity_id_s1, r.entity_id_other): (r.score, r.rank) for r in retrieval.top_k(*(retrieval.weights(x, "entity_id", "name_alnum", idf) for x in (left, right)), 3).collect()}
    tally = {}
    for _, text in rows:
        grams = [g for w in (text or "").split() for n in (3, 4, 5) if n == 3 or n <= len(w) + 2 for g in (f" {w} "[i : i + n] for i in range(len(w) + 3 - n))]
        for g in set(grams):
            df, total = tally.get(g, (0, 0))
            tally[g] = df + 1, total + grams.count(g)
    assert {r.gram: (r.df, r.total) for r in spark.createDataFrame([(t or "",) for _, t in rows], "text string").mapInArrow(retrieval._gram_totals, "gram string, df long, total long").groupBy("gram").agg(F.sum("df").alias("df"), F.sum("total").alias("total")).collect()} == tally
    for chars, piece, head in ((24 << 20, 1 << 20, 4096), (100, 40, 4096), (100, 1 << 20, 0)):
        for name, value in (("BLOCK_CHARS", chars), ("SLICE_CHARS", piece), ("HEAD", head)):
            monkeypatch.setattr(retrieval, name, value)
        found = retrieval.retrieve(left, right, "name_alnum", k=3)
        assert {(r.entity_id_s1, r.entity_id_other): (r.score, r.rank) for r in found.collect()} == want
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in plan and "other_block" not in plan and "hashpartitioning(gram" not in plan and "hashpartitioning(id" not in plan


def test_similarities_of_many_pairs_at_once(monkeypatch):
    """Pairs that are combed together score what each scores alone, long texts, empty ones and repeats among them."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcde é ") for _ in range(rng.randint(0, n)))
    pairs = [(text(12 if i % 4 else 150), text(14 if i % 3 else 150)) for i in range(700)]
    pairs += pairs[:50]
    want = [tuple(f(a, b) for f in S.KINDS.values()) for a, b in pairs]
    assert S.scores_of(pairs, tuple(S.KINDS)) == want
    for few in (1, 10**6):
        monkeypatch.setattr(S, "FEW", few)
        monkeypatch.setattr(S, "FEW_LCS", few)
        assert S.scores_of(pairs, tuple(S.KINDS)) == want
    left, right = ["abcab", "xx"], ["bcabcabca", "axbx"]
    down, m = S._combed(left, right)
    for c, (a, b) in enumerate(zip(left, right)):
        assert all(j - i - sum(down[r, c] >= m + i for r in range(j)) == S.lcs(a, b[i:j]) for i in range(len(b)) for j in range(i, len(b) + 1))


def test_pairs_of_all_lengths_are_made_at_once(monkeypatch):
    """Texts of many lengths and scripts score what each pair scores alone, and none of up to SHORT characters is made alone."""
    rng = random.Random(9)
    text = lambda: "".join(rng.choice("abcdefé漢   " + chr(0x400 + rng.randint(0, 300))) for _ in range(rng.randint(0, 120)))
    pairs = [(text(), text()) for _ in range(400)] + [("", ""), (" ", "a"), ("a a", "a"), ("ab " * 40, "ba " * 40)]
    want = [tuple(f(a, b) for f in S.KINDS.values()) for a, b in pairs]
    alone, lcs = [], S._lcs
    monkeypatch.setattr(S, "_lcs", lambda where, n, b: alone.append(n) or lcs(where, n, b))
    assert S.scores_of(pairs, tuple(S.KINDS)) == want and not alone
    assert [S.scores_of(pairs, (k,)) for k in S.KINDS] == [[(w[i],) for w in want] for i in range(len(S.KINDS))]


def test_feature_table_keeps_records(spark, tmp_path, monkeypatch):
    """Pages are read for their records once; the features are made from kept ones."""
    from tessera.plans import queries

    rows = [(i, f"http://a.example/{i}", f"<html lang='en'><title>some title {i % 5} here</title></html>") for i in range(30)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    seen, made = [], queries.candidates
    monkeypatch.setattr(queries, "candidates", lambda left, right, s: seen.append((left, right)) or made(left, right, s))
    assert queries.queries()["feature_separation"](spark, str(tmp_path)).count() == 20
    assert all("InMemoryTableScan" in d._jdf.queryExecution().executedPlan().toString() for d in seen[0])
    spark.catalog.clearCache()


def test_features_are_made_in_many_tasks(spark):
    """Pairs come dealt by their ids where they are made distinct; small ones stood in one task from there on."""
    from tessera.operators import features

    left = records(spark, [(f"S1-{i}", "same name", f"{i} street", "us") for i in range(8)])
    right = records(spark, [(f"S2-{i}", "same name", f"{i} road", "us") for i in range(8)])
    d = features.features(blocking.flagged(blocking.pairs_by_rule(left, right)), left, right)
    assert d.rdd.getNumPartitions() >= 4 and d.count() == 64


def test_models_are_fitted_in_few_tasks(spark, monkeypatch):
    from pyspark.ml import Pipeline

    from tessera.operators import models

    seen, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, data: seen.append((data.rdd.getNumPartitions(), data.count())) or fit(self, data))
    table = spark.range(400).selectExpr("concat('S1-', id) as entity_id_s1", "concat('S2-', id) as entity_id_other", "id * 1.0 as x", "int(id > 200) as label").repartition(50)
    model = models.PairModel.fit("boosted", table, ["x"], maxIter=2, maxDepth=2)
    assert seen == [(1, 400)]
    assert model.score(table).where("(score > 0.5) = (label = 1)").count() == 400
    monkeypatch.setattr(models, "PART_ROWS", 100)
    models.PairModel.fit("boosted", table, ["x"], maxIter=1, maxDepth=2)
    assert seen[1] == (4, 400)


def test_kept_training_rows_are_not_copied(spark, monkeypatch):
    """A model is fitted on a part of a kept table as it is, in few tasks, and scores what one of its own copy scores."""
    from pyspark.ml import Pipeline

    from tessera.operators import models

    seen, fit, kept = [], Pipeline.fit, spark.sparkContext._jsc.sc().getPersistentRDDs
    monkeypatch.setattr(Pipeline, "fit", lambda self, data: seen.append((data.rdd.getNumPartitions(), kept().size())) or fit(self, data))
    table = spark.range(400).selectExpr("concat('S1-', id) as entity_id_s1", "concat('S2-', id) as entity_id_other", "id * 1.0 as x", "int(id > 200) as label").repartition(50).persist()
    table.count()
    before = kept().size()
    found = [models.PairModel.fit("forest", table.where("x < 350"), ["x"], numTrees=3, maxDepth=2, **kw).score(table).sort("entity_id_s1").collect() for kw in ({}, {"kept": True})]
    assert seen == [(1, before + 1), (1, before)] and found[0] == found[1]
    table.unpersist()


def test_retrieval_holds_a_tile_of_products(spark, monkeypatch):
    """Equal texts are compared once, ids decide ties among them and other texts, and products stand in tiles of bounded size."""
    from tessera.operators import retrieval

    texts = ["same words", "words same", "same words here", "other words", "", None, "éa b"]
    left = records(spark, [(f"S1-{i}", texts[i % 7], "", "us") for i in range(21)])
    right = records(spark, [(f"S{2 + i % 2}-{i}", texts[i * i % 7], "", "us") for i in range(60)])
    idf = retrieval.fit(left.union(right), "name_alnum").persist()
    want = sorted(map(tuple, retrieval.top_k(*(retrieval.weights(x, "entity_id", "name_alnum", idf) for x in (left, right)), 4).collect()))
    for tile, rows in ((1 << 21, 1 << 13), (4, 2)):
        monkeypatch.setattr(retrieval, "TILE", tile)
        monkeypatch.setattr(retrieval, "BLOCK_ROWS", rows)
        found = retrieval.retrieve(left, right, "name_alnum", k=4, idf=idf)
        assert sorted((r.entity_id_s1, r.entity_id_other, r.score, r["rank"]) for r in found.collect()) == want
    block = retrieval.Block(retrieval.Vectors(np.arange(1001), np.zeros(1000, np.int32), np.ones(1000)), 2)
    right = retrieval.Vectors(np.arange(5001), np.zeros(5000, np.int32), np.ones(5000))
    assert block.products(right, 10, 12).shape == (2, 1000)


def test_left_sets_are_sent_as_codes(spark, monkeypatch):
    """Sets that are sent as codes meet as those of cells do, frequent items, others and none; repeated pairs count once, right sets travel once."""
    from tessera.operators import features

    rng = random.Random(12)
    side = lambda s, n: [(f"{s}-{i}", sorted(rng.sample(range(-40, 40), rng.randint(0, 12))), sorted(rng.sample(range(9), 2)), i) for i in range(n)]
    l, r = side("S1", 30), side("S2", 50)
    pairs = [(a[0], b[0]) for a in l for b in r if rng.random() < 0.3]
    frame = lambda rows: spark.createDataFrame(rows, "entity_id string, s array<long>, t array<long>, n int")
    s, t, n = ({x[0]: x[k] for x in (*l, *r)} for k in (1, 2, 3))
    given = spark.createDataFrame(pairs + pairs[:40], "entity_id_s1 string, entity_id_other string")
    for codes, block in ((1 << 16, 1 << 22), (5, 90), (0, 1 << 22)):
        monkeypatch.setattr(features, "CODES", codes)
        monkeypatch.setattr(features, "SENT_BLOCK", block)
        monkeypatch.setattr(features, "CODE_SHARE", 1)
        found = features.overlaps(given, frame(l), frame(r), ["s", "t"], numbers=["n"])
        assert sorted(map(tuple, found.collect())) == sorted((a, b, len({*s[a]} & {*s[b]}), len({*t[a]} & {*t[b]}), n[a], n[b]) for a, b in pairs)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(x" in plan and "y#" not in plan
    monkeypatch.setattr(features, "SENT_ITEMS", 10)
    cells = features.overlaps(given, frame(l), frame(r), ["s", "t"], numbers=["n"])
    assert sorted(map(tuple, cells.collect())) == sorted(map(tuple, found.collect()))
    assert "y#" in cells._jdf.queryExecution().executedPlan().toString()


def test_records_too_large_to_send_are_joined_first(spark, monkeypatch):
    """What is shuffled for a pair are its ids, not texts of the side that is sent."""
    from tessera.operators import features

    d = lambda s, n, size: spark.createDataFrame([(f"{s}-{i}", "x" * size) for i in range(n)], "entity_id string, t string")
    monkeypatch.setattr(features, "BROADCAST_CHARS", 1000)
    pairs = spark.createDataFrame([("S1-0", "S2-1"), ("S1-1", "S2-0")], "entity_id_s1 string, entity_id_other string")
    found = features.with_records(pairs, d("S1", 2, 10), d("S2", 9, 500), ["t"])
    assert sorted((r.entity_id_s1, r.entity_id_other, len(r.t_s1), len(r.t_other)) for r in found.collect()) == [("S1-0", "S2-1", 10, 500), ("S1-1", "S2-0", 10, 500)]
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert "entity_id_s1" in next(x for x in plan if "Join" in x)
