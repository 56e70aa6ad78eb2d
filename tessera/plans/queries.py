"""Queries of the record-linkage engine over the entity view, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.functions import pairs as P
from tessera.functions.similarity import similarities
from tessera.functions.text import normalized
from tessera.operators import audit, blocking, decide, features, models, retrieval, sampling, validate
from tessera.plans import entities
from tessera.plans.pipeline import Settings, candidates, link

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, tuple[str, str]] = {}


def _register(name: str, sql: str | None = None, view: str = entities.SQL):
    def keep(f: Query) -> Query:
        _queries[name] = f
        if sql is not None:
            _sql[name] = view, sql
        return f

    return keep


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return {k: f"with {view}\n{sql}" if not sql.lstrip().startswith(",") else f"with {view}{sql}" for k, (view, sql) in _sql.items()}


def _norm(spark: SparkSession, sf: str) -> DataFrame:
    return normalized(entities.records(spark, sf))


def _by_side(d: DataFrame) -> tuple[DataFrame, DataFrame]:
    return d.where(F.col("entity_id").startswith("S1-")), d.where(~F.col("entity_id").startswith("S1-"))


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return _by_side(_norm(spark, sf))


def _candidates(spark: SparkSession, sf: str, **kw) -> DataFrame:
    return blocking.pairs_by_rule(*_sides(spark, sf), **kw)


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return blocking.pairs(*_sides(spark, sf))


# ---------------------------------------------------------------- records


@_register("norm_names", "select entity_id, name_norm, name_alnum, name_core, name_compact, array_to_string(name_tokens, '|') as name_tokens, name_sorted, name_first_token from norm")
def norm_names(spark, sf):
    return _norm(spark, sf).select("entity_id", "name_norm", "name_alnum", "name_core", "name_compact", F.array_join("name_tokens", "|").alias("name_tokens"), "name_sorted", "name_first_token")


@_register("norm_addresses", "select entity_id, address_norm, address_alnum, address_compact, address_sorted, address_first_number, country_norm from norm")
def norm_addresses(spark, sf):
    return _norm(spark, sf).select("entity_id", "address_norm", "address_alnum", "address_compact", "address_sorted", "address_first_number", "country_norm")


@_register("number_tokens", "select entity_id, array_to_string(name_numbers, '|') as name_numbers, array_to_string(address_numbers, '|') as address_numbers from norm")
def number_tokens(spark, sf):
    return _norm(spark, sf).select("entity_id", F.array_join("name_numbers", "|").alias("name_numbers"), F.array_join("address_numbers", "|").alias("address_numbers"))


@_register("postal_token", "select entity_id, address_postal from norm")
def postal_token(spark, sf):
    return _norm(spark, sf).select("entity_id", "address_postal")


# ---------------------------------------------------------------- blocking

_POSTINGS = """, posts as materialized (
  select entity_id, rule, key, occurrences from (
    select entity_id, 'exact_name' as rule, name_norm as key, 1 as occurrences from norm union all
    select entity_id, 'exact_address', address_norm, 1 from norm union all
    select entity_id, 'name_first_token_country', name_first_token || '|' || country_norm, 1 from norm union all
    select entity_id, 'name_first_two_tokens', case when len(name_tokens) >= 2 then name_tokens[1] || ' ' || name_tokens[2] else '' end, 1 from norm union all
    select entity_id, 'address_number_country', address_first_number || '|' || country_norm, 1 from norm union all
    select entity_id, 'name_compact_prefix', substr(name_compact, 1, 6), 1 from norm union all
    select entity_id, 'rare_name_token', t, count(*) from (select entity_id, unnest(name_tokens) as t from norm) where length(t) >= 3 group by entity_id, t
  ) where key <> ''
)"""
_PAIRS = f"""{_POSTINGS}, sided as materialized (select *, substr(entity_id, 1, 3) as side from posts
), few as materialized (
  select side, rule, key from (select side, rule, key, sum(occurrences) as n from sided group by side, rule, key)
  where n <= case when rule = 'rare_name_token' and side <> 'S1-' then {blocking.RARE_LIMIT} else {blocking.MAX_BLOCK} end
), kept as materialized (select s.entity_id, s.side, s.rule, s.key from sided s join few f on f.side = s.side and f.rule = s.rule and f.key = s.key
), cand as materialized (
  select distinct l.entity_id as entity_id_s1, r.entity_id as entity_id_other, l.rule from kept l join kept r on l.rule = r.rule and l.key = r.key
  where l.entity_id like 'S1-%' and r.entity_id not like 'S1-%'
), pairs as (select distinct entity_id_s1, entity_id_other from cand)"""


def _block(rule: str):
    @_register(f"block_{rule}", f"{_PAIRS} select entity_id_s1, entity_id_other, rule from cand where rule = '{rule}'")
    def block(spark, sf):
        return _candidates(spark, sf, rules=[rule])


for _rule in blocking.RULES:
    _block(_rule)


@_register("capped_merge_names", f"select a.entity_id as entity_id_s1, b.entity_id as entity_id_other from norm a join norm b on a.name_norm = b.name_norm where a.entity_id like 'S1-%' and b.entity_id like 'S2-%' and a.name_norm <> '' and (select count(*) from norm c where c.entity_id like 'S1-%' and c.name_norm = a.name_norm) <= 2 and (select count(*) from norm c where c.entity_id like 'S2-%' and c.name_norm = a.name_norm) <= 2")
def capped_merge_names(spark, sf):
    n = _norm(spark, sf).select("entity_id", "name_norm")
    a, b = n.where(F.col("entity_id").startswith("S1-")), n.where(F.col("entity_id").startswith("S2-"))
    return blocking.capped_merge(a.withColumnRenamed("entity_id", "entity_id_s1"), b.withColumnRenamed("entity_id", "entity_id_other"), "name_norm", 2).select("entity_id_s1", "entity_id_other")


@_register("block_union_flags", f"{_PAIRS} select entity_id_s1, entity_id_other, " + ", ".join(f"bool_or(rule = '{r}') as found_by_{r}" for r in blocking.RULES) + ", count(*)::int as n_blocking_rules from cand group by 1, 2")
def block_union_flags(spark, sf):
    d = blocking.flagged(_candidates(spark, sf))
    return d.select("entity_id_s1", "entity_id_other", *(f"found_by_{r}" for r in blocking.RULES), "n_blocking_rules")


@_register("block_summary", f"{_PAIRS}, each as (select entity_id_s1, count(*) as n from pairs group by 1) select coalesce(sum(n), 0)::bigint as n_unique_pairs, count(*) as n_s1_with_candidates, coalesce(avg(n), 0)::double as avg_candidates, coalesce(median(n), 0)::double as median_candidates, coalesce(max(n), 0)::bigint as max_candidates from each")
def block_summary(spark, sf):
    return blocking.summary(_candidates(spark, sf))


@_register("block_rule_counts", f"{_PAIRS} select rule, count(*) as n from cand group by rule")
def block_rule_counts(spark, sf):
    return _candidates(spark, sf).groupBy("rule").agg(F.count("*").alias("n"))


# A run in chunks counts the left side within each; here languages are the chunks, and a block has 20 rows, so both branches run.
_SCOPED = f"{_POSTINGS}, sided as (select p.*, n.country_norm as chunk, substr(p.entity_id, 1, 3) as side from posts p join norm n using (entity_id)), l as (select rule, key, chunk from sided where side = 'S1-' group by 1, 2, 3 having sum(occurrences) <= 20), r as (select rule, key, side from sided where side <> 'S1-' group by 1, 2, 3 having sum(occurrences) <= 20)"


@_register("block_within_chunks", f"{_SCOPED} select distinct a.entity_id as entity_id_s1, b.entity_id as entity_id_other, a.rule from sided a join l on a.rule = l.rule and a.key = l.key and a.chunk = l.chunk join sided b on b.rule = a.rule and b.key = a.key join r on r.rule = b.rule and r.key = b.key and r.side = b.side where a.side = 'S1-' and b.side <> 'S1-'")
def block_within_chunks(spark, sf):
    return _candidates(spark, sf, max_block=20, scope="country_norm")


@_register("postings_lookup", f"{_POSTINGS} select entity_id, rule, key, occurrences::bigint as occurrences from posts")
def postings_lookup(spark, sf):
    return blocking.postings(_norm(spark, sf)).withColumn("occurrences", F.col("occurrences").cast("long"))


@_register("rare_token_counts", f"{_POSTINGS} select key as token, sum(occurrences)::bigint as occurrences from posts where rule = 'rare_name_token' group by key having sum(occurrences) <= 50")
def rare_token_counts(spark, sf):
    c = blocking.key_counts(blocking.postings(_norm(spark, sf), ["rare_name_token"]))
    return c.where(F.col("rows") <= blocking.RARE_LIMIT).select(F.col("key").alias("token"), F.col("rows").alias("occurrences"))


# ---------------------------------------------------------------- rarity and pair features

_IDF = ", tok as (select distinct entity_id, unnest(name_tokens) as token from norm), idf as (select token, count(*) as df, ln(((select count(*) from norm) + 1) / (count(*) + 1)::double) + 1 as idf from tok group by token)"


def _rarity(n: DataFrame) -> DataFrame:
    n = features.with_rarity(n, features.idf_table(n, "name_tokens"), "name_tokens", "name")
    return features.with_rarity(n, features.idf_table(n, "address_tokens"), "address_tokens", "address")


@_register("idf_tokens", f"{_IDF} select token, df, round(idf, 6) as idf from idf")
def idf_tokens(spark, sf):
    return features.idf_table(_norm(spark, sf), "name_tokens").select("token", "df", F.round("idf", 6).alias("idf"))


@_register("avg_idf", f"{_IDF}, each as (select entity_id, unnest(name_tokens) as token from norm) select n.entity_id, round(coalesce(a.v, 0), 6) as avg_idf from norm n left join (select entity_id, avg(idf) as v from each join idf using (token) group by 1) a using (entity_id)")
def avg_idf(spark, sf):
    n = _norm(spark, sf)
    return features.with_rarity(n, features.idf_table(n, "name_tokens"), "name_tokens", "name").select("entity_id", F.round("name_avg_idf", 6).alias("avg_idf"))


@_register("rare_overlap", f"{_PAIRS}{_IDF} select entity_id_s1, entity_id_other, round(coalesce(sum(case when idf >= 6 then idf end), 0), 6) as overlap from pairs left join tok a on a.entity_id = entity_id_s1 left join tok b on b.entity_id = entity_id_other and b.token = a.token left join idf on idf.token = b.token group by 1, 2")
def rare_overlap(spark, sf):
    n = _norm(spark, sf).select("entity_id", "name_tokens")
    idf = features.idf_table(n, "name_tokens")
    # a token of one record alone is common to no pair
    rare = idf.where((F.col("idf") >= P.RARE_IDF) & (F.col("df") > 1)).select("token", "idf")
    each = n.select("entity_id", F.explode(F.array_distinct("name_tokens")).alias("token")).join(rare, "token")
    each = each.groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct(F.xxhash64("token").alias("t"), "idf"))).alias("e"))
    rows = n.select("entity_id").join(each, "entity_id", "left").select("entity_id", F.coalesce("e.t", F.array().cast("array<long>")).alias("rare"), F.coalesce("e.idf", F.array().cast("array<double>")).alias("idf"))
    d = features.overlaps(_pairs(spark, sf), *_by_side(rows), ["rare"], weights="idf")
    return d.select("entity_id_s1", "entity_id_other", F.round("rare_common", 6).alias("overlap"))


_JOINED = f"{_PAIRS}, j as (select p.*, " + ", ".join(f"a.{c} as {c}_s1, b.{c} as {c}_other" for c in features.RECORD) + " from pairs p join norm a on a.entity_id = p.entity_id_s1 join norm b on b.entity_id = p.entity_id_other)"


def _joined(spark, sf, *columns: str) -> DataFrame:
    return features.with_records(_pairs(spark, sf), *_sides(spark, sf), list(columns))


def _jaccard_sql(c: str) -> str:
    inter, union = f"len(list_intersect({c}_s1, {c}_other))", f"len(list_distinct(list_concat({c}_s1, {c}_other)))"
    return f"round(case when {union} = 0 then 1.0 else {inter} / {union}::double end, 6)"


@_register("pair_set_features", f"{_JOINED} select entity_id_s1, entity_id_other, {_jaccard_sql('name_tokens')} as name_jaccard, {_jaccard_sql('address_tokens')} as address_jaccard, len(list_intersect(name_tokens_s1, name_tokens_other))::int as common, round(len(list_intersect(name_tokens_s1, name_tokens_other)) / greatest(1, least(len(name_tokens_s1), len(name_tokens_other)))::double, 6) as common_ratio from j")
def pair_set_features(spark, sf):
    kinds = ("name", "address")
    n = _norm(spark, sf).select("entity_id", F.size("name_tokens").alias("name_size"), *(features.item_set(f"{k}_tokens").alias(k) for k in kinds))
    n = n.withColumns({f"{k}_distinct": F.size(k) for k in kinds})
    d = features.overlaps(blocking.pairs(*_sides(spark, sf), repeats=True), *_by_side(n), list(kinds), numbers=["name_size", "name_distinct", "address_distinct"])
    d = d.withColumns({f"{k}_common": F.col(f"{k}_common").cast("int") for k in kinds})
    name, address = (F.round(P.jaccard_of(F.col(f"{k}_common"), F.col(f"{k}_distinct_s1"), F.col(f"{k}_distinct_other")), 6).alias(f"{k}_jaccard") for k in kinds)
    shorter = F.greatest(F.lit(1), F.least("name_size_s1", "name_size_other"))
    return d.select("entity_id_s1", "entity_id_other", name, address, F.col("name_common").alias("common"), F.round(F.col("name_common") / shorter, 6).alias("common_ratio"))


@_register("pair_number_features", f"{_JOINED} select entity_id_s1, entity_id_other, {_jaccard_sql('name_numbers')} as digit_jaccard, (list_sort(name_numbers_s1) = list_sort(name_numbers_other) and len(name_numbers_s1) + len(name_numbers_other) > 0)::int as digit_exact, (address_numbers_s1 = address_numbers_other and len(address_numbers_s1) + len(address_numbers_other) > 0)::int as number_sequence, (address_postal_s1 = address_postal_other and address_postal_s1 <> '')::int as postal_agree, (address_postal_s1 = '' or address_postal_other = '')::int as postal_missing from j")
def pair_number_features(spark, sf):
    d = _joined(spark, sf, "name_numbers", "address_numbers", "address_postal")
    both = lambda f, c: f(F.col(f"{c}_s1"), F.col(f"{c}_other"))
    return d.select("entity_id_s1", "entity_id_other", F.round(both(P.jaccard, "name_numbers"), 6).alias("digit_jaccard"), both(P.same_items, "name_numbers").alias("digit_exact"), both(P.same_sequence, "address_numbers").alias("number_sequence"), both(P.agree, "address_postal").alias("postal_agree"), both(P.either_missing, "address_postal").alias("postal_missing"))


@_register("pair_length_features", f"{_JOINED} select entity_id_s1, entity_id_other, abs(length(name_alnum_s1) - length(name_alnum_other))::int as len_diff, round(least(length(name_alnum_s1), length(name_alnum_other)) / greatest(1, length(name_alnum_s1), length(name_alnum_other))::double, 6) as len_ratio, (name_alnum_s1 <> '' and name_alnum_other <> '' and left(name_alnum_s1, 3) = left(name_alnum_other, 3))::int as prefix_agree, (name_alnum_s1 <> '' and name_alnum_other <> '' and right(name_alnum_s1, 3) = right(name_alnum_other, 3))::int as suffix_agree, (length(address_alnum_s1) > 0 and length(address_alnum_other) > 0)::int as both_present from j")
def pair_length_features(spark, sf):
    # A pair carries what the features read of a record, not its texts.
    n = _norm(spark, sf).select("entity_id", F.length("name_alnum").alias("length"), F.left("name_alnum", F.lit(3)).alias("prefix"), F.right("name_alnum", F.lit(3)).alias("suffix"), (F.length("address_alnum") > 0).alias("present"))
    d = features.with_records(_pairs(spark, sf), *_by_side(n), ["length", "prefix", "suffix", "present"])
    both = lambda f, c: f(F.col(f"{c}_s1"), F.col(f"{c}_other"))
    ratio = both(F.least, "length") / F.greatest(F.lit(1), "length_s1", "length_other")
    return d.select("entity_id_s1", "entity_id_other", F.abs(F.col("length_s1") - F.col("length_other")).alias("len_diff"), F.round(ratio, 6).alias("len_ratio"), both(P.agree, "prefix").alias("prefix_agree"), both(P.agree, "suffix").alias("suffix_agree"), (F.col("present_s1") & F.col("present_other")).cast("int").alias("both_present"))


@_register("pair_country_features", f"{_JOINED} select entity_id_s1, entity_id_other, (country_norm_s1 = country_norm_other)::int as country_match, (country_norm_s1 = '')::int as missing_s1, (country_norm_other = '')::int as missing_other, (entity_id_other like 'S3-%')::int as is_source3 from j")
def pair_country_features(spark, sf):
    d = _joined(spark, sf, "country_norm")
    a, b = F.col("country_norm_s1"), F.col("country_norm_other")
    return d.select("entity_id_s1", "entity_id_other", P.equal(a, b).alias("country_match"), P.equal(a, F.lit("")).alias("missing_s1"), P.equal(b, F.lit("")).alias("missing_other"), F.col("entity_id_other").startswith("S3-").cast("int").alias("is_source3"))


# DuckDB's edit distances count bytes, so these queries compare names in which each character beyond ASCII is a '?'.
_PLAIN = {s: f"regexp_replace(name_alnum_{s}, '[^\\x00-\\x7F]', '?', 'g')" for s in ("s1", "other")}
_LEV = f"case when greatest(length(name_alnum_s1), length(name_alnum_other)) = 0 then 1.0 else 1 - levenshtein({_PLAIN['s1']}, {_PLAIN['other']}) / greatest(length(name_alnum_s1), length(name_alnum_other))::double end"


def _plain(c: str):
    return F.regexp_replace(c, r"[^\x00-\x7F]", "?")


def _page_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    return _by_side(normalized(entities.page_records(spark, sf)))


def _page_pairs(spark, sf, *columns: str) -> DataFrame:
    left, right = _page_sides(spark, sf)
    return features.with_records(features.spread(blocking.pairs_by_rule(left, right).select("entity_id_s1", "entity_id_other").distinct()), left, right, list(columns))


@_register("pair_levenshtein", f"{_JOINED} select entity_id_s1, entity_id_other, round({_LEV}, 6) as similarity from j", entities.PAGES_SQL)
def pair_levenshtein(spark, sf):
    d = _page_pairs(spark, sf, "name_alnum")
    return d.select("entity_id_s1", "entity_id_other", F.round(P.levenshtein_similarity(_plain("name_alnum_s1"), _plain("name_alnum_other")), 6).alias("similarity"))


@_register("pair_jaro_winkler", f"{_JOINED} select entity_id_s1, entity_id_other, round(jaro_winkler_similarity({_PLAIN['s1']}, {_PLAIN['other']}), 6) as similarity from j where name_alnum_s1 <> '' and name_alnum_other <> ''", entities.PAGES_SQL)
def pair_jaro_winkler(spark, sf):
    d = _page_pairs(spark, sf, "name_alnum").where("name_alnum_s1 <> '' and name_alnum_other <> ''")
    return d.select("entity_id_s1", "entity_id_other", F.round(similarities(_plain("name_alnum_s1"), _plain("name_alnum_other"), "jaro_winkler")["jaro_winkler"], 6).alias("similarity"))


@_register("pair_fuzzy_all")
def pair_fuzzy_all(spark, sf):
    d = _page_pairs(spark, sf, "name_alnum", "address_alnum")
    name, addr = similarities(F.col("name_alnum_s1"), F.col("name_alnum_other")), similarities(F.col("address_alnum_s1"), F.col("address_alnum_other"), "ratio", "wratio", "partial_ratio")
    return d.select("entity_id_s1", "entity_id_other", name.alias("n"), addr.alias("a")).select("entity_id_s1", "entity_id_other", "n.*", *(F.col(f"a.{k}").alias(f"address_{k}") for k in ("ratio", "wratio", "partial_ratio")))


def _feature_table(spark, sf) -> DataFrame:
    # kept: records are read a dozen times, and each time whole pages would be read for their titles
    n = normalized(entities.page_records(spark, sf)).persist()
    return features.features(candidates(*_by_side(n), Settings()), *_by_side(_rarity(n).persist()))


@_register("pair_features")
def pair_features(spark, sf):
    return _feature_table(spark, sf)


@_register("rule_score")
def rule_score(spark, sf):
    left, right = _page_sides(spark, sf)
    pairs = blocking.flagged(blocking.pairs_by_rule(left, right))
    return models.PairModel("rule", []).score(features.features(pairs, left, right, models.RULE_COLUMNS))


# ---------------------------------------------------------------- retrieval


def _tfidf_sql(column: str, k: int) -> str:
    return f""", words as (select entity_id, word, ' ' || word || ' ' as w from (select entity_id, unnest(list_filter(string_split({column}, ' '), lambda t: t <> '')) as word from norm)
), g as (
  select entity_id, case when length(w) <= n then w else substr(w, i::int, n::int) end as gram
  from (select entity_id, w, n, unnest(range(1, greatest(length(w) - n + 1, 1) + 1)) as i from words, (select unnest([3, 4, 5]) as n) where n <= length(w) or n = 3)
), tf as (select entity_id, gram, count(*) as tf from g group by 1, 2
), vocab as (select gram, count(*) as df, sum(tf) as total from tf group by gram order by total desc, gram limit 200000
), wt as (select entity_id, gram, tf * (ln((1 + (select count(*) from norm)) / (1 + df)::double) + 1) as w from tf join vocab using (gram)
), nrm as (select entity_id, sqrt(sum(w * w)) as norm from wt group by 1
), u as (select entity_id, gram, w / nrm.norm as w from wt join nrm using (entity_id)
), dots as (
  select a.entity_id as entity_id_s1, b.entity_id as entity_id_other, round(sum(a.w * b.w), 6) as score from u a join u b using (gram)
  where a.entity_id like 'S1-%' and b.entity_id not like 'S1-%' group by 1, 2
)
select * from (select *, row_number() over (partition by entity_id_s1, substr(entity_id_other, 1, 3) order by score desc, entity_id_other)::int as rank from dots) where rank <= {k}"""


def _topk(column: str):
    @_register(f"tfidf_topk_{column.split('_')[0]}", _tfidf_sql(column, 20))
    def topk(spark, sf):
        left, right = _sides(spark, sf)
        return retrieval.retrieve(left, right, column).select("entity_id_s1", "entity_id_other", "score", "rank")


_topk("name_alnum")
_topk("address_alnum")

# ---------------------------------------------------------------- decisions on a SQL score

# Decisions read the share of common name tokens.
_SCORES = f"{_JOINED}, scores as (select entity_id_s1, entity_id_other, {_jaccard_sql('name_tokens')} as score from j), uni as (select entity_id from ent where entity_id like 'S1-%')"


def _scores(spark, sf) -> DataFrame:
    n = _norm(spark, sf).select("entity_id", features.item_set("name_tokens").alias("name")).withColumn("distinct", F.size("name"))
    d = features.overlaps(_pairs(spark, sf), *_by_side(n), ["name"], numbers=["distinct"])
    return d.select("entity_id_s1", "entity_id_other", F.round(P.jaccard_of(F.col("name_common"), F.col("distinct_s1"), F.col("distinct_other")), 6).alias("score"))


def _universe(spark, sf) -> DataFrame:
    return entities.records(spark, sf).select("entity_id").where(F.col("entity_id").startswith("S1-"))


def _entity_sql(pred: str, by: str = "") -> str:
    """CTE e: per-entity metrics of the pairs in pred (columns by, ids)."""
    c = f"{by}, " if by else ""
    grid = f"cross join (select distinct {by} from grid)" if by else ""
    on = f"and p.{by} = x.{by}" if by else ""
    return f""", x as (select {c}entity_id as id from uni {grid}
), pp as (select distinct {c}entity_id_s1, entity_id_other from {pred}
), c as (
  select {"x." + by + ", " if by else ""}x.id as source1_id, (select count(distinct entity_id_other) from truth t where t.entity_id_s1 = x.id) as n_true,
    count(p.entity_id_other) as n_pred, count(t.entity_id_other) as n_tp
  from x left join pp p on p.entity_id_s1 = x.id {on} left join (select distinct * from truth) t on t.entity_id_s1 = p.entity_id_s1 and t.entity_id_other = p.entity_id_other group by {'x.' + by + ', ' if by else ''}x.id
), pr as (
  select *, case when n_pred = 0 and n_true = 0 then 1.0::double when n_pred = 0 then 0.0::double else n_tp / n_pred::double end as precision,
    case when n_pred = 0 and n_true = 0 then 1.0::double when n_true = 0 or n_pred = 0 then 0.0::double else n_tp / n_true::double end as recall from c
), e as (select *, case when 0.25 * precision + recall > 0 then 1.25 * precision * recall / (0.25 * precision + recall) else 0.0::double end as f05 from pr)"""


_ACCEPTED = ", pred as (select entity_id_s1, entity_id_other from scores where score >= 0.6)"


@_register("entity_f05", _SCORES + _ACCEPTED + _entity_sql("pred") + " select source1_id, n_true, n_pred, n_tp, round(precision, 6) as precision, round(recall, 6) as recall, round(f05, 6) as f05 from e")
def entity_f05(spark, sf):
    e = decide.entity_scores(decide.accepted(_scores(spark, sf), 0.6), entities.truth(spark, sf), _universe(spark, sf))
    return e.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f05")})


@_register("macro_f05", _SCORES + _ACCEPTED + _entity_sql("pred") + " select round(avg(f05), 6) as macro_f05, round(avg(precision), 6) as macro_precision, round(avg(recall), 6) as macro_recall, round(avg(case when n_true = 0 then (n_pred = 0)::int end), 6) as singleton_accuracy, count(*) as n_entities from e")
def macro_f05(spark, sf):
    return decide.macro(decide.entity_scores(decide.accepted(_scores(spark, sf), 0.6), entities.truth(spark, sf), _universe(spark, sf)))


@_register("worst_entities", _SCORES + _ACCEPTED + _entity_sql("pred") + " select source1_id, n_true, n_pred, round(f05, 6) as f05 from e order by e.f05, source1_id limit 20")
def worst_entities(spark, sf):
    e = decide.entity_scores(decide.accepted(_scores(spark, sf), 0.6), entities.truth(spark, sf), _universe(spark, sf))
    return audit.worst(e).select("source1_id", "n_true", "n_pred", F.round("f05", 6).alias("f05"))


@_register("pair_prf", _SCORES + _ACCEPTED + ", m as (select (select count(*) from pred p join (select distinct * from truth) t using (entity_id_s1, entity_id_other)) as tp, (select count(*) from pred) as np, (select count(*) from (select distinct * from truth)) as nt) select tp, np - tp as fp, nt - tp as fn, round(tp / np::double, 6) as pair_precision, round(tp / nt::double, 6) as pair_recall from m")
def pair_prf(spark, sf):
    d = decide.pair_metrics(decide.accepted(_scores(spark, sf), 0.6), entities.truth(spark, sf))
    return d.select("tp", "fp", "fn", F.round("pair_precision", 6).alias("pair_precision"), F.round("pair_recall", 6).alias("pair_recall"))


_GRID = ", grid as (select unnest([" + ", ".join(f"{t}::double" for t in decide.COARSE) + "]) as threshold), pred as (select threshold, entity_id_s1, entity_id_other from scores, grid where score >= threshold)"


@_register("threshold_grid", _SCORES + _GRID + _entity_sql("pred", "threshold") + " select threshold, round(avg(f05), 6) as macro_f05, round(avg(precision), 6) as macro_precision, round(avg(recall), 6) as macro_recall, round(avg(case when n_true = 0 then (n_pred = 0)::int end), 6) as singleton_accuracy, round(case when sum(n_pred) > 0 then sum(n_tp) / sum(n_pred)::double end, 6) as pair_precision, round(case when sum(n_true) > 0 then sum(n_tp) / sum(n_true)::double end, 6) as pair_recall, round(sum(n_pred) / count(*)::double, 6) as avg_predicted_matches from e group by threshold")
def threshold_grid(spark, sf):
    return decide.threshold_table(_scores(spark, sf), entities.truth(spark, sf), _universe(spark, sf))


_LEVELS = (
    ", grid as (select s || '|' || t as level, s, t from (select unnest(['S2-', 'S3-']) as s), (select unnest([" + ", ".join(f"{t}::double" for t in decide.BY_SOURCE) + "]) as t)"
    "), pred as (select level, entity_id_s1, entity_id_other from scores join grid on substr(entity_id_other, 1, 3) = s and score >= t)"
)


@_register("source_thresholds", _SCORES + _LEVELS + _entity_sql("pred", "level") + ", best as (select s, t, row_number() over (partition by s order by round(avg(f05), 6) desc, t) as place from e join grid using (level) group by s, t) select case s when 'S2-' then 'source2' else 'source3' end as source, case when (select count(*) from scores where entity_id_other like s || '%') >= 100 then t else 0.6::double end as threshold from best where place = 1")
def source_thresholds(spark, sf):
    found = decide.source_thresholds(_scores(spark, sf), entities.truth(spark, sf), _universe(spark, sf), 0.6, min_pairs=100)
    return spark.createDataFrame(list(found.items()), "source string, threshold double")


@_register("gap_policy", _SCORES + ", r as (select *, row_number() over w as place, score - coalesce(lead(score) over w, -1.0) as gap from scores window w as (partition by entity_id_s1 order by score desc, entity_id_other)) select entity_id_s1, entity_id_other, score from r where not (place = 1 and gap < 0.1) and score >= 0.5")
def gap_policy(spark, sf):
    return decide.decide(_scores(spark, sf), 0.5, min_gap=0.1)


@_register("one_parent", _SCORES + " select entity_id_s1, entity_id_other, score from (select *, row_number() over (partition by entity_id_other order by score desc, entity_id_s1) as place from scores where score >= 0.5) where place = 1")
def one_parent(spark, sf):
    return decide.decide(_scores(spark, sf), 0.5, single_parent=True)


@_register("match_lists", _SCORES + _ACCEPTED + " select entity_id as source1_entity_id, coalesce(string_agg(entity_id_other, ',' order by entity_id_other), '') as matched_entity_ids from uni left join pred on entity_id_s1 = entity_id group by entity_id")
def match_lists(spark, sf):
    return validate.output_frame(decide.accepted(_scores(spark, sf), 0.6), _universe(spark, sf))


@_register("exact_name_matches", f"{_PAIRS}, pred as (select distinct entity_id_s1, entity_id_other from cand where rule = 'exact_name'), uni as (select entity_id from ent where entity_id like 'S1-%')" + _entity_sql("pred") + ", l as (select entity_id_s1, string_agg(entity_id_other, ',' order by entity_id_other) as ids from pred group by 1) select source1_id, coalesce(ids, '') as matched_entity_ids, round(f05, 6) as f05 from e left join l on entity_id_s1 = source1_id")
def exact_name_matches(spark, sf):
    pred = _candidates(spark, sf, rules=["exact_name"])
    e = decide.entity_scores(pred, entities.truth(spark, sf), _universe(spark, sf)).select("source1_id", F.round("f05", 6).alias("f05"))
    lists = decide.match_lists(pred, _universe(spark, sf)).withColumnRenamed("source1_entity_id", "source1_id")
    return e.join(lists, "source1_id").select("source1_id", "matched_entity_ids", "f05")


@_register("candidate_recall", f"{_PAIRS}, t as (select distinct * from truth) select n_true, n_found, round(n_found / n_true::double, 6) as recall from (select (select count(*) from t) as n_true, (select count(*) from t join pairs using (entity_id_s1, entity_id_other)) as n_found)")
def candidate_recall(spark, sf):
    return decide.candidate_recall(_candidates(spark, sf), entities.truth(spark, sf), _universe(spark, sf))


@_register("labels", f"{_PAIRS} select entity_id_s1, entity_id_other, (t.entity_id_s1 is not null)::int as label from pairs left join (select distinct * from truth) t using (entity_id_s1, entity_id_other)")
def labels(spark, sf):
    return decide.labels(_candidates(spark, sf).select("entity_id_s1", "entity_id_other").distinct(), entities.truth(spark, sf))


@_register("matches_outside_candidates", _SCORES + " select distinct s.entity_id_s1, s.entity_id_other from (select * from scores where score >= 0.5) s anti join (select * from cand where rule = 'exact_name') c using (entity_id_s1, entity_id_other)")
def matches_outside_candidates(spark, sf):
    return decide.outside_candidates(decide.accepted(_scores(spark, sf), 0.5), _candidates(spark, sf, rules=["exact_name"]))


# ---------------------------------------------------------------- samples, audits, checks


@_register("entity_split", ", uni as (select entity_id, row_number() over (order by md5('42|' || entity_id), entity_id) as place from ent where entity_id like 'S1-%') select entity_id, case when place <= floor((select count(*) from uni) * 0.25) then 'validation' else 'train' end as part from uni")
def entity_split(spark, sf):
    return sampling.split(_universe(spark, sf))


@_register("background_pool", ", ids as (select entity_id from ent where entity_id like 'S2-%'), gone as (select entity_id_other as entity_id from truth) select entity_id from ids anti join gone using (entity_id) order by md5('42|' || entity_id), entity_id limit 100")
def background_pool(spark, sf):
    ids = entities.records(spark, sf).select("entity_id").where(F.col("entity_id").startswith("S2-"))
    return sampling.background(ids, entities.truth(spark, sf).select(F.col("entity_id_other").alias("entity_id")).distinct(), 100)


@_register("training_pool", ", wanted as (select distinct entity_id_other as entity_id from truth), pool as (select entity_id from wanted where entity_id like 'S2-%' union all (select entity_id from ent anti join wanted using (entity_id) where entity_id like 'S2-%' order by md5('42|' || entity_id), entity_id limit 50) union all select entity_id from wanted where entity_id like 'S3-%' union all (select entity_id from ent anti join wanted using (entity_id) where entity_id like 'S3-%' order by md5('43|' || entity_id), entity_id limit 50)) select entity_id from pool")
def training_pool(spark, sf):
    r = entities.records(spark, sf)
    pool = sampling.training_pool(_universe(spark, sf), {k: r.where(F.col("entity_id").startswith(k)) for k in ("S2-", "S3-")}, entities.truth(spark, sf), size=50)
    return pool["S2-"].select("entity_id").union(pool["S3-"].select("entity_id"))


@_register("source_subset", " select entity_id, country from ent where entity_id in (select entity_id_other from truth)")
def source_subset(spark, sf):
    wanted = entities.truth(spark, sf).select(F.col("entity_id_other").alias("entity_id"))
    return entities.records(spark, sf).select("entity_id", "country").join(wanted, "entity_id", "left_semi")


@_register("truth_exploded", " select entity_id_s1, unnest(string_split(ids, ',')) as entity_id_other from (select entity_id_s1, string_agg(entity_id_other, ',' order by entity_id_other) as ids from truth group by 1)")
def truth_exploded(spark, sf):
    from tessera.sources.files import exploded_truth

    return exploded_truth(decide.match_lists(entities.truth(spark, sf), _universe(spark, sf)))


_RESULTS = ", res as (select entity_id_s1 as s1, string_agg(entity_id_other, ',' order by entity_id_other) as ids from truth group by 1 union all select 'S9-1', 'S1-0,X-7,S2-none,S2-1,S2-1' union all select 'S9-2', 'S2-1,' union all select min(entity_id_s1), 'S3-2' from truth), item as (select distinct unnest(string_split(ids, ',')) as id from res), uni as (select entity_id as id from ent where entity_id like 'S1-%')"


@_register("validator_violations", _RESULTS + " select 'duplicate_row' as \"check\", s1 as id from res group by s1 having count(*) > 1 union all select distinct 'repeated_id', s1 from res where len(string_split(ids, ',')) > len(list_distinct(string_split(ids, ','))) union all select 'self_match', id from item where id like 'S1-%' union all select 'wrong_prefix', id from item where not regexp_matches(id, '^S[123]-') union all select 'unknown_id', id from item where regexp_matches(id, '^S[23]-') and id not in (select entity_id from ent) union all select 'missing_row', id from uni where id not in (select s1 from res) union all select distinct 'extra_row', s1 from res where s1 not in (select id from uni)")
def validator_violations(spark, sf):
    t = entities.truth(spark, sf)
    more = spark.createDataFrame([("S9-1", "S1-0,X-7,S2-none,S2-1,S2-1"), ("S9-2", "S2-1,")], "a string, b string")
    twice = t.agg(F.min("entity_id_s1").alias("a")).select("a", F.lit("S3-2").alias("b"))
    return validate.violations(decide.match_lists(t).union(more).union(twice), _universe(spark, sf), entities.records(spark, sf))


@_register("audit_counts", " select case substr(entity_id, 1, 2) when 'S1' then 'source1' when 'S2' then 'source2' else 'source3' end as name, count(*) as n_rows from ent group by 1 union all select 'truth', count(*) from truth")
def audit_counts(spark, sf):
    r = entities.records(spark, sf)
    tables = {f"source{k}": r.where(F.col("entity_id").startswith(f"S{k}-")) for k in (1, 2, 3)}
    return audit.counts(tables | {"truth": entities.truth(spark, sf)})


@_register("data_profile", " select count(*) as n_rows, count(distinct entity_id) as n_ids, count(distinct business_name) as n_names, count(distinct business_address) as n_addresses, round(avg((coalesce(business_name, '') = '')::int), 6) as empty_names, round(avg((coalesce(business_address, '') = '')::int), 6) as empty_addresses, round(avg(length(business_name)), 6) as mean_name_length, round(avg(length(business_address)), 6) as mean_address_length from ent")
def data_profile(spark, sf):
    return audit.profile(entities.records(spark, sf))


@_register("country_counts", " select country, count(*) as n from ent group by country")
def country_counts(spark, sf):
    return audit.country_counts(entities.records(spark, sf))


@_register("match_histogram", " select n_matches, count(*) as n_entities from (select e.entity_id, count(t.entity_id_other) as n_matches from ent e left join truth t on t.entity_id_s1 = e.entity_id where e.entity_id like 'S1-%' group by 1) group by 1")
def match_histogram(spark, sf):
    return audit.match_histogram(entities.truth(spark, sf), _universe(spark, sf))


@_register("match_fan_in", " select n_parents, count(*) as n_ids from (select entity_id_other, count(distinct entity_id_s1) as n_parents from truth group by 1) group by 1")
def match_fan_in(spark, sf):
    return audit.fan_in(entities.truth(spark, sf))


@_register("feature_separation")
def feature_separation(spark, sf):
    table = decide.labels(_feature_table(spark, sf), entities.page_truth(spark, sf))
    return audit.separation(table, features.feature_columns(table))


# ---------------------------------------------------------------- models


def _model(name: str):
    @_register(f"ml_{name}")
    def fitted(spark, sf):
        ids = entities.page_records(spark, sf).select("entity_id").where(F.col("entity_id").startswith("S1-"))
        table = decide.labels(_feature_table(spark, sf), entities.page_truth(spark, sf)).join(sampling.split(ids).withColumnRenamed("entity_id", "entity_id_s1"), "entity_id_s1").persist()
        columns = [c for c in features.feature_columns(table) if c != "part"]
        model = models.PairModel.fit(name, table.where("part = 'train'"), columns)
        return model.score(table.where("part = 'validation'"))


_model("logistic")
_model("forest")
_model("boosted")


@_register("end_to_end")
def end_to_end(spark, sf):
    r = entities.page_records(spark, sf).drop("h")
    left, right = r.where(F.col("entity_id").startswith("S1-")), r.where(~F.col("entity_id").startswith("S1-"))
    return link(left, right, threshold=0.61)
