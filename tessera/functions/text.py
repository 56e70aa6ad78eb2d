"""Scalar text functions: cleaning, tokens, numbers, postal codes, as Column expressions.

Python's notion of word characters and white space is kept: letters and numbers of every script and the underscore
are words, combining marks are not; white space is every separator and the control characters that split lines.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

SPACE = r"[\x{1C}-\x{1F}\x{85}\p{Z}\s]"
NOT_WORD = r"[^\p{L}\p{N}_]"
NOT_WORD_OR_SPACE = r"[^\p{L}\p{N}_\x{1C}-\x{1F}\x{85}\p{Z}\s]"
APOSTROPHES = "[‘’ʼ']"

# Legal forms and company words that a core name leaves out.
LEGAL_SUFFIXES = (
    "inc", "incorporated", "corp", "corporation", "co", "company", "llc", "llp", "lp", "ltd", "limited", "pvt", "private",
    "plc", "gmbh", "sa", "sas", "sarl", "bv", "nv", "ag", "kg", "oy", "ab", "spa", "srl", "pllc", "pc", "assoc", "associates",
    "group", "holdings", "enterprises", "ent", "intl", "international", "natl", "national",
)

NAME_COLUMNS = ["name_raw", "name_norm", "name_alnum", "name_core", "name_compact", "name_tokens", "name_sorted", "name_numbers", "name_first_token"]
ADDRESS_COLUMNS = ["address_raw", "address_norm", "address_alnum", "address_compact", "address_tokens", "address_sorted", "address_numbers", "address_postal", "address_first_number"]


@pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility composition; text in ASCII passes untouched. SQL has no such function."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def collapse(c: Column) -> Column:
    """One space for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def clean(c: Column, *, compose: bool = True) -> Column:
    """Composed, lower-cased, & spelled out, apostrophes gone, white space collapsed. Null is empty."""
    text = F.coalesce(c, F.lit(""))
    text = F.lower(nfkc(text) if compose else text)
    return collapse(F.regexp_replace(F.replace(text, F.lit("&"), F.lit(" and ")), APOSTROPHES, ""))


def alnum(c: Column) -> Column:
    return collapse(F.regexp_replace(c, NOT_WORD_OR_SPACE, " "))


def compact(c: Column) -> Column:
    return F.regexp_replace(c, NOT_WORD, "")


def numbers(c: Column) -> Column:
    """All digit runs in order."""
    return F.regexp_extract_all(c, F.lit(r"(\p{Nd}+)"), F.lit(1))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def core(toks: Column) -> Column:
    """Tokens that are no legal form, joined."""
    return F.array_join(F.filter(toks, lambda t: ~t.isin(*LEGAL_SUFFIXES)), " ")


def sorted_tokens(toks: Column) -> Column:
    return F.array_join(F.array_sort(toks), " ")


def first(items: Column) -> Column:
    return F.coalesce(F.get(items, F.lit(0)), F.lit(""))


def postal(nums: Column) -> Column:
    """The longest digit run of four or more; the first of equal ones; else empty."""
    longer = lambda best, x: F.when((F.length(x) >= 4) & (F.length(x) > F.length(best)), x).otherwise(best)
    return F.aggregate(nums, F.lit(""), longer)


def normalized(df: DataFrame, *, compose: bool = True) -> DataFrame:
    """The 21-column form of entity_id, business_name, business_address, country."""
    df = df.select(
        "entity_id",
        F.coalesce("business_name", F.lit("")).alias("name_raw"),
        F.coalesce("business_address", F.lit("")).alias("address_raw"),
        F.coalesce("country", F.lit("")).alias("country"),
        clean(F.col("business_name"), compose=compose).alias("name_norm"),
        clean(F.col("business_address"), compose=compose).alias("address_norm"),
        clean(F.col("country"), compose=compose).alias("country_norm"),
    )
    df = df.withColumns({f"{p}_alnum": alnum(F.col(f"{p}_norm")) for p in ("name", "address")} | {f"{p}_compact": compact(F.col(f"{p}_norm")) for p in ("name", "address")} | {f"{p}_numbers": numbers(F.col(f"{p}_norm")) for p in ("name", "address")})
    df = df.withColumns({f"{p}_tokens": tokens(F.col(f"{p}_alnum")) for p in ("name", "address")})
    df = df.withColumns(
        {
            "name_core": core(F.col("name_tokens")),
            "name_sorted": sorted_tokens(F.col("name_tokens")),
            "name_first_token": first(F.col("name_tokens")),
            "address_sorted": sorted_tokens(F.col("address_tokens")),
            "address_postal": postal(F.col("address_numbers")),
            "address_first_number": first(F.col("address_numbers")),
        }
    )
    return df.select("entity_id", *NAME_COLUMNS, *ADDRESS_COLUMNS, "country", "country_norm")
