"""Functions of two values: overlaps, ratios, agreements."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

RARE_IDF, UNSEEN_IDF = 6.0, 12.0


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def jaccard(a: Column, b: Column) -> Column:
    """Of two lists as sets; both empty: 1."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def jaccard_of(common: Column, n: Column, m: Column) -> Column:
    """The same from the number of common items and each side's number of distinct ones: no set is built twice."""
    return F.when(n + m == 0, 1.0).otherwise(common / (n + m - common))


def common_count(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def common_ratio(a: Column, b: Column) -> Column:
    """Common items over the shorter list's length, repeats counted in the length."""
    return common_count(a, b) / F.greatest(F.lit(1), F.least(F.size(a), F.size(b)))


def rare_overlap(a: Column, b: Column, idf: Column) -> Column:
    """Sum of the weights of common tokens that weigh RARE_IDF or more. idf: map of one side's tokens."""
    weight = lambda t: F.coalesce(F.element_at(idf, t), F.lit(UNSEEN_IDF))
    return F.aggregate(F.array_sort(F.array_intersect(a, b)), F.lit(0.0), lambda s, t: s + F.when(weight(t) >= RARE_IDF, weight(t)).otherwise(0.0))


def prefix_agree(a: Column, b: Column, n: int = 3) -> Column:
    return _flag((a != "") & (b != "") & (F.left(a, F.lit(n)) == F.left(b, F.lit(n))))


def suffix_agree(a: Column, b: Column, n: int = 3) -> Column:
    return _flag((a != "") & (b != "") & (F.right(a, F.lit(n)) == F.right(b, F.lit(n))))


def same_items(a: Column, b: Column) -> Column:
    """Equal lists whatever their order, and not both empty."""
    return _flag((F.array_sort(a) == F.array_sort(b)) & (F.size(a) + F.size(b) > 0))


def same_sequence(a: Column, b: Column) -> Column:
    return _flag((a == b) & (F.size(a) + F.size(b) > 0))


def agree(a: Column, b: Column) -> Column:
    """Equal and not empty."""
    return _flag((a == b) & (a != ""))


def equal(a: Column, b: Column) -> Column:
    return _flag(a == b)


def either_missing(a: Column, b: Column) -> Column:
    return _flag((a == "") | (b == ""))


def length_diff(a: Column, b: Column) -> Column:
    return F.abs(F.length(a) - F.length(b))


def length_ratio(a: Column, b: Column) -> Column:
    return F.least(F.length(a), F.length(b)) / F.greatest(F.lit(1), F.length(a), F.length(b))


def both_present(a: Column, b: Column) -> Column:
    return _flag((F.length(a) > 0) & (F.length(b) > 0))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    most = F.greatest(F.length(a), F.length(b))
    return F.when(most == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / most)
