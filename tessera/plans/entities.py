"""Entity views over the test tables: documents, and pages, read as records of three sources; the former in SQL form, too."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.functions.text import LEGAL_SUFFIXES


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, business_name, business_address, country, h of every document; doc_id mod 3 says the source.

    The whole text is read: its first line is the name, all the rest the address.
    """
    k, line = F.col("doc_id") % 3, F.substring_index("text", "\n", 1)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.concat(F.lit("S"), (k + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        line.alias("business_name"),
        F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)").alias("business_address"),
        F.col("lang").alias("country"),
        F.md5("text").alias("h"),
    )


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same columns of every page: its title element is the name, its address the address; h is of the title.

    For similarities that slide windows over texts: these fields are short as they are.
    """
    k, first = F.col("page_id") % 3, lambda pattern: F.regexp_extract("html", pattern, 1)
    title = first(r"(?is)<title[^>]*>(.*?)</title>")
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        F.concat(F.lit("S"), (k + 1).cast("string"), F.lit("-"), F.col("page_id").cast("string")).alias("entity_id"),
        title.alias("business_name"),
        F.col("url").alias("business_address"),
        first(r"(?i)<html[^>]*\slang=[\"']?([A-Za-z]+)").alias("country"),
        F.md5(title).alias("h"),
    )


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of source 1 with the others whose whole texts are equal."""
    return _same(records(spark, sf_dir))


def page_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of source 1 with the others whose titles are equal."""
    return _same(page_records(spark, sf_dir))


def _same(found: DataFrame) -> DataFrame:
    r = found.select("entity_id", "h")
    a, b = r.where(F.col("entity_id").startswith("S1-")), r.where(~F.col("entity_id").startswith("S1-"))
    return a.withColumnRenamed("entity_id", "entity_id_s1").join(b.withColumnRenamed("entity_id", "entity_id_other"), "h").select("entity_id_s1", "entity_id_other")


_WS = r"[\x{1C}-\x{1F}\x{85}\p{Z}\s]"


def _collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_WS}+', ' ', 'g'))"


def _clean(c: str) -> str:
    return _collapse(f"regexp_replace(replace(lower(coalesce({c}, '')), '&', ' and '), '[‘’ʼ'']', '', 'g')")


def _alnum(c: str) -> str:
    return _collapse(rf"regexp_replace({c}, '[^\p{{L}}\p{{N}}_\x{{1C}}-\x{{1F}}\x{{85}}\p{{Z}}\s]', ' ', 'g')")


_SUFFIXES = ", ".join(f"'{s}'" for s in LEGAL_SUFFIXES)

_DOCUMENTS = """
  select concat('S', doc_id % 3 + 1, '-', doc_id) as entity_id, split_part(text, chr(10), 1) as business_name, substr(text, length(split_part(text, chr(10), 1)) + 2) as business_address, lang as country, md5(text) as h from documents
"""
_PAGES = r"""
  select concat('S', page_id % 3 + 1, '-', page_id) as entity_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) as business_name, url as business_address, regexp_extract(html, '(?i)<html[^>]*\slang=["'']?([A-Za-z]+)', 1) as country, md5(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) as h from pages
"""
_NORM = rf"""), n0 as (
  select entity_id, h, coalesce(business_name, '') as name_raw, coalesce(business_address, '') as address_raw, coalesce(country, '') as country,
    {_clean("business_name")} as name_norm, {_clean("business_address")} as address_norm, {_clean("country")} as country_norm from ent
), n1 as (
  select *, {_alnum("name_norm")} as name_alnum, {_alnum("address_norm")} as address_alnum,
    regexp_replace(name_norm, '[^\p{{L}}\p{{N}}_]', '', 'g') as name_compact, regexp_replace(address_norm, '[^\p{{L}}\p{{N}}_]', '', 'g') as address_compact,
    regexp_extract_all(name_norm, '\p{{Nd}}+') as name_numbers, regexp_extract_all(address_norm, '\p{{Nd}}+') as address_numbers from n0
), n2 as (
  select *, list_filter(string_split(name_alnum, ' '), lambda t: t <> '') as name_tokens, list_filter(string_split(address_alnum, ' '), lambda t: t <> '') as address_tokens from n1
), norm as materialized (
  select *, array_to_string(list_filter(name_tokens, lambda t: t not in ({_SUFFIXES})), ' ') as name_core,
    array_to_string(list_sort(name_tokens), ' ') as name_sorted, coalesce(name_tokens[1], '') as name_first_token,
    array_to_string(list_sort(address_tokens), ' ') as address_sorted, coalesce(address_numbers[1], '') as address_first_number,
    list_reduce(list_prepend('', list_filter(address_numbers, lambda t: length(t) >= 4)), lambda a, b: case when length(b) > length(a) then b else a end) as address_postal
  from n2
), truth as (
  select a.entity_id as entity_id_s1, b.entity_id as entity_id_other from ent a join ent b on a.h = b.h where a.entity_id like 'S1-%' and b.entity_id not like 'S1-%'
)"""

#: Common table expressions over documents and over pages: ent (records), n0..n2 and norm (normalised), truth.
SQL, PAGES_SQL = (f"\nent as ({view}{_NORM}" for view in (_DOCUMENTS, _PAGES))
