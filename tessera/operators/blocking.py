"""Candidate pairs: seven blocking rules over one table of postings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Rules in the order in which their rows are told.
RULES = ("exact_name", "exact_address", "name_first_token_country", "name_first_two_tokens", "address_number_country", "name_compact_prefix", "rare_name_token")
#: A key with more rows than this on either side is left out.
MAX_BLOCK = 400
#: Occurrences on the other side up to which a token is rare, and its least length.
RARE_LIMIT, RARE_LENGTH = 50, 3
PREFIX = 6


def _key(rule: str) -> Column:
    return {
        "exact_name": lambda: F.col("name_norm"),
        "exact_address": lambda: F.col("address_norm"),
        "name_first_token_country": lambda: F.concat("name_first_token", F.lit("|"), "country_norm"),
        "name_first_two_tokens": lambda: F.when(F.size("name_tokens") >= 2, F.array_join(F.slice("name_tokens", 1, 2), " ")).otherwise(""),
        "address_number_country": lambda: F.concat("address_first_number", F.lit("|"), "country_norm"),
        "name_compact_prefix": lambda: F.left("name_compact", F.lit(PREFIX)),
    }[rule]()


def postings(records: DataFrame, rules: Sequence[str] = RULES) -> DataFrame:
    """entity_id, rule, key, occurrences of every record, from one pass; empty keys are left out."""
    fixed = [F.struct(F.lit(r).alias("rule"), _key(r).alias("key"), F.lit(1).alias("occurrences")) for r in rules if r != "rare_name_token"]
    entries = F.array(*fixed) if fixed else F.expr("array(named_struct('rule', '', 'key', '', 'occurrences', 1))")
    if "rare_name_token" in rules:
        long = F.filter("name_tokens", lambda t: F.length(t) >= RARE_LENGTH)
        times = lambda t: F.size(F.filter(F.col("name_tokens"), lambda u: u == t))
        entries = F.concat(entries, F.transform(F.array_distinct(long), lambda t: F.struct(F.lit("rare_name_token").alias("rule"), t.alias("key"), times(t).alias("occurrences"))))
    return records.select("entity_id", F.inline(entries)).where("key <> ''")


def source_of(entity_id: str) -> Column:
    """S2 of S2-17; empty where the id names no source."""
    return F.regexp_extract(entity_id, r"^(S\d+)-", 1)


def key_counts(entries: DataFrame) -> DataFrame:
    return entries.groupBy("rule", "key").agg(F.sum("occurrences").alias("rows"))


def _short(key: Column) -> Column:
    """A key, of which long ones (whole addresses) are told by their digest: only equality counts from here on. Short keys never look like one."""
    return F.when(F.octet_length(key) > 32, F.concat(F.lit("#"), F.md5(key))).otherwise(key)


def pairs_by_rule(left: DataFrame, right: DataFrame, *, rules: Sequence[str] = RULES, max_block: int = MAX_BLOCK, rare_limit: int = RARE_LIMIT, scope: str | None = None, apart: bool = True) -> DataFrame:
    """entity_id_s1, entity_id_other, rule: pairs that share a key of at most max_block rows on each side.

    Keys are counted first (sums that combine before the shuffle), so a hot key never reaches the join. A token counts
    by its occurrences, and only one rare on the right makes pairs. scope names a column of left: rows are then
    counted within its values, as a run in chunks would. Rows of the right side are counted for each source alone,
    unless apart is false: then all of them together.
    """
    l = postings(left, rules)
    l = l.join(left.select("entity_id", scope), "entity_id") if scope else l
    r = postings(right, rules).withColumn("source", source_of("entity_id") if apart else F.lit(""))
    return matched(l, r, max_block=max_block, rare_limit=rare_limit, scope=scope)


def pairs(left: DataFrame, right: DataFrame, *, repeats: bool = False, **kw) -> DataFrame:
    """entity_id_s1, entity_id_other of pairs_by_rule, each pair once; with repeats once for each key, for those who drop repeats themselves."""
    r = postings(right).withColumn("source", source_of("entity_id"))
    found = _met(postings(left), r, **kw).select("entity_id_s1", "entity_id_other")
    return found if repeats else found.distinct()


def matched(l: DataFrame, r: DataFrame, **kw) -> DataFrame:
    """pairs_by_rule of postings; the right ones have their source, too."""
    return _met(l, r, **kw).select("entity_id_s1", "entity_id_other", "rule").distinct()


def _met(l: DataFrame, r: DataFrame, *, max_block: int = MAX_BLOCK, rare_limit: int = RARE_LIMIT, scope: str | None = None) -> DataFrame:
    within = [scope] if scope else []
    l, r = (d.withColumn("key", _short(F.col("key"))) for d in (l, r))
    few = r.groupBy("rule", "key", "source").agg(F.sum("occurrences").alias("rows")).where(F.col("rows") <= F.when(F.col("rule") == "rare_name_token", min(rare_limit, max_block)).otherwise(max_block)).select("rule", "key", "source")
    fewer = l.groupBy("rule", "key", *within).agg(F.sum("occurrences").alias("rows")).where(F.col("rows") <= max_block).drop("rows")
    live = fewer.join(few, ["rule", "key"])
    l = l.join(live, ["rule", "key", *within]).select("rule", "key", "source", F.col("entity_id").alias("entity_id_s1"))
    r = r.select("rule", "key", "source", F.col("entity_id").alias("entity_id_other"))
    return l.join(r, ["rule", "key", "source"])


def capped_merge(left: DataFrame, right: DataFrame, key: str, cap: int) -> DataFrame:
    """The inner join on key, of keys that are not empty and have at most cap rows on each side."""
    few = lambda d: d.where(F.col(key) != "").groupBy(key).agg(F.count("*").alias("rows")).where(F.col("rows") <= cap).select(key)
    return left.join(few(left).join(few(right), key), key).join(right, key)


def flagged(pairs: DataFrame, *, rules: Sequence[str] = RULES) -> DataFrame:
    """One row a pair: found_by_* for each rule and retrieval, retrieval scores, and how many found it."""
    extra = ("tfidf_name", "tfidf_address")
    if "score" not in pairs.columns:
        pairs = pairs.withColumn("score", F.lit(None).cast("double"))
    found = pairs.groupBy("entity_id_s1", "entity_id_other").agg(
        *(F.bool_or(F.col("rule") == r).alias(f"found_by_{r}") for r in (*rules, *extra)),
        *(F.max(F.when(F.col("rule") == r, F.col("score"))).alias(f"tfidf_score_{r[6:]}") for r in extra),
    )
    return found.withColumn("n_blocking_rules", sum((F.col(f"found_by_{r}").cast("int") for r in (*rules, *extra)), F.lit(0)))


def summary(pairs: DataFrame) -> DataFrame:
    """n_unique_pairs, n_s1_with_candidates and mean, median, maximum of pairs for each entity that has one; one row."""
    each = pairs.select("entity_id_s1", "entity_id_other").distinct().groupBy("entity_id_s1").agg(F.count("*").alias("n"))
    zero = lambda c, kind: F.coalesce(c, F.lit(0)).cast(kind)
    return each.agg(
        zero(F.sum("n"), "long").alias("n_unique_pairs"),
        F.count("*").alias("n_s1_with_candidates"),
        zero(F.avg("n"), "double").alias("avg_candidates"),
        zero(F.percentile("n", F.lit(0.5)), "double").alias("median_candidates"),
        zero(F.max("n"), "long").alias("max_candidates"),
    )
