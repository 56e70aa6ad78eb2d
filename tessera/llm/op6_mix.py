"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.common import cut, small

WORD = r"[^\x20\x09-\x0D]+"
#: Characters that mark markup left-overs and shouting.
JUNK = "#$%&*|!"
#: Bits of a key's place on the line from 0 to 1, and those by which ranges of it are split at a time.
PLACE_BITS, STEP_BITS = 50, 10
#: Rows of a source up to which they are put in order in one task; a range of more is split again.
EDGE_ROWS = 10_000


def quality_weight(text: Column) -> Column:
    """1 for clean text, falling with the share of junk characters."""
    n = F.length(text)
    junk = n - F.length(F.translate(text, JUNK, ""))
    return F.when(n > 0, 1 / (1 + 20 * junk / n)).otherwise(F.lit(1.0))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    source_weights: tuple[float, ...] = (5, 2, 1),
    budget: float = 1.5,
    most: int = 2,
    seed: str = "mix-1",
    weight: Column | None = None,
) -> DataFrame:
    """How many words of each document a mix of sources takes.

    A document's size is its number of words (null or empty text: 0). Sources in code point order, null last,
    weigh source_weights in turn and share budget times all words; a target stops at most times its source's
    size and the rest is shared again by weight. Each source is taken in whole epochs first. The words left of
    its target are drawn from documents in order of Efraimidis-Spirakis keys -ln(u)/w, where u comes from a hash
    of seed, id and text, and w from weight (by default quality_weight); the last document drawn is cut to the
    words still wanted, so a source's taken words are its target's whole part.

    Ties fall by id and text hash; repeated rows are documents of their own. An empty table gives no rows.
    Returns id_col, size, source_size, target, taken, source_col, tie (of id and text). Only id_col, text_col and
    source_col are read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    h = _hash(id_col, text_col, seed)
    u = (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    key = -F.log(u) / F.greatest(quality_weight(text) if weight is None else weight, F.lit(1e-6))
    d = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.when(F.col(source_col).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source_col))).alias("skey"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        key.alias("key"),
        F.substring(h, 1, 16).alias("tie"),
    )
    # where a key lies on the line from 0 to 1, as a whole number: ranges are its leading bits
    d = cut(d.withColumn("place", F.least(F.floor((1 - F.exp(-F.col("key"))) * float(1 << PLACE_BITS)), F.lit((1 << PLACE_BITS) - 1)).cast("long")))
    own_range = lambda shift: F.shiftright("place", shift)

    # One row for each source and range; rank order and shares need only one row for each source.
    shift = PLACE_BITS - STEP_BITS
    sums = cut(d.groupBy("skey", "source", own_range(shift).alias("range")).agg(F.sum("size").alias("words"), F.count("*").alias("rows")))
    src = targets(sums.groupBy("skey", "source").agg(F.sum("words").alias("source_size")), source_weights, budget, most)
    wanted = F.floor("target").cast("long")
    src = src.withColumn("epochs", F.when(F.col("source_size") > 0, F.least(F.floor(wanted / F.col("source_size")), F.lit(most))).otherwise(0).cast("long"))
    src = cut(src.withColumn("rest", wanted - F.col("epochs") * F.col("source_size")))

    # The range in which a source's rest ends, split until few rows are left in it (or one place).
    by_range = Window.partitionBy("skey").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)

    def edge_of(sums: DataFrame, start: DataFrame) -> DataFrame:
        passed = F.col("base") + F.coalesce(F.sum("words").over(by_range), F.lit(0))
        found = sums.join(small(start), "skey").withColumn("before", passed)
        return cut(found.where("rest > before and rest <= before + words").select("skey", "rest", F.col("range").alias("edge"), "before", "rows"))

    edge = edge_of(sums, src.select("skey", "rest", F.lit(0).alias("base")))
    while shift and edge.where(F.col("rows") > EDGE_ROWS).limit(1).count():
        inside = d.join(small(edge.select("skey", "edge")), "skey").where(own_range(shift) == F.col("edge"))
        shift -= STEP_BITS
        inner = inside.groupBy("skey", own_range(shift).alias("range")).agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
        edge = edge_of(inner, edge.select("skey", "rest", F.col("before").alias("base")))
    edge = edge.drop("rest", "rows")
    d = d.withColumn("range", own_range(shift))
    plan = src.select("skey", "source_size", "target", "epochs", "rest").join(edge, "skey", "left")
    d = d.join(small(cut(plan)), "skey")

    whole = F.col("epochs") * F.col("size")
    out = ["id", "size", "source_size", "target", "taken", "source", "tie"]
    outside = d.where("edge is null or range <> edge").withColumn("taken", whole + F.when(F.col("range") < F.col("edge"), F.col("size")).otherwise(0))
    in_order = Window.partitionBy("skey").orderBy("key", "id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    inside = d.where("range = edge").withColumn("passed", F.col("before") + F.coalesce(F.sum("size").over(in_order), F.lit(0)))
    inside = inside.withColumn("taken", whole + F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("passed"))))
    return outside.select(out).unionByName(inside.select(out)).withColumnsRenamed({"id": id_col, "source": source_col})


def _hash(id_col: str, text_col: str, seed: str) -> Column:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit("|"), F.md5(text)))


def mixed(docs: DataFrame, *, seed: str = "mix-1", **how) -> DataFrame:
    """The mix itself: rows of docs (doc_id, text, lang, source, n_chars), each as often as it is taken.

    A document that is taken in part at last has a row with its first words, and n_chars of these. Documents of
    which nothing is taken are left out. Of rows equal in id, text and source, which are drawn alike, the first by
    lang and n_chars takes the most.
    """
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    key = ["k", "tie", "s"]
    own = lambda d: d.withColumns({"k": F.coalesce("doc_id", F.lit(-1)), "s": F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))})
    taken = own(mix(docs, seed=seed, **how).where("taken > 0"))
    plan = cut(taken.groupBy(*key, "size").agg(F.sort_array(F.collect_list("taken"), False).alias("takes")))
    keyed = own(docs.select(*cols)).withColumn("tie", F.substring(_hash("doc_id", "text", seed), 1, 16))
    once = plan.where("size(takes) = 1").select(*key, F.col("size"), F.col("takes")[0].alias("taken"))
    d = keyed.join(once, key)
    several = plan.where("size(takes) > 1")
    if several.limit(1).count():
        nth = F.row_number().over(Window.partitionBy(*key).orderBy("lang", "n_chars"))
        again = keyed.join(several, key).withColumn("nth", nth).where(F.col("nth") <= F.size("takes"))
        d = d.unionByName(again.withColumn("taken", F.element_at("takes", F.col("nth"))).drop("nth", "takes"))
    whole, rest = F.floor(F.col("taken") / F.col("size")).cast("int"), F.col("taken") % F.col("size")
    parts = F.array_repeat(F.lit(0), whole)
    d = d.withColumn("words", F.explode(F.when(rest > 0, F.concat(parts, F.array(rest.cast("int")))).otherwise(parts)))
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), F.lit(1), F.greatest(F.col("words"), F.lit(1))), "")
    text = F.when(F.col("words") == 0, F.col("text")).otherwise(head)
    n_chars = F.when(F.col("words") == 0, F.col("n_chars")).otherwise(F.length(head))
    return d.select("doc_id", text.alias("text"), "lang", "source", n_chars.cast("long").alias("n_chars"))


def targets(src: DataFrame, source_weights: tuple[float, ...], budget: float, most: int) -> DataFrame:
    """Adds target: shares of budget times all words by weight, none above most times its source's size.

    Sources in order of limit over weight: those up to the first whose limit lies above the level stay at their limit.
    One row a source is ordered here, after aggregation.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in source_weights]), (F.col("rank") % len(source_weights) + 1).cast("int"))
    src = src.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("weight", pick)
    src = src.withColumn("limit", most * F.col("source_size"))
    by_fill = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before, everything = by_fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    src = (
        src.withColumn("place", F.row_number().over(by_fill))
        .withColumn("full", F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (budget * F.sum("source_size").over(everything) - F.col("full")) / (F.sum("weight").over(everything) - F.col("gone")))
    )
    first = F.min(F.when(F.col("limit") / F.col("weight") > F.col("level"), F.struct("place", "level"))).over(everything)
    src = src.withColumn("stop", first)
    target = F.when(F.col("stop").isNull() | (F.col("place") < F.col("stop.place")), F.col("limit").cast("double"))
    return src.withColumn("target", target.otherwise(F.col("weight") * F.col("stop.level"))).select("skey", "source", "source_size", "target")


ORACLE_SQL = f"""
with d as (
  select doc_id, source, coalesce(text, '') as text from documents
), h as (
  select doc_id, source, len(regexp_extract_all(text, '{WORD}')) as size,
    md5('mix-1|' || coalesce(doc_id::varchar, '-') || '|' || md5(text)) as h,
    case when length(text) > 0 then 1 / (1 + 20.0::double * (length(text) - length(translate(text, '{JUNK}', ''))) / length(text)) else 1.0 end::double as w
  from d
), k as (
  select *, -ln((('0x' || substr(h, 1, 13))::bigint::double + 0.5) / 4503599627370496.0::double) / greatest(w, 1e-6) as key, substr(h, 1, 16) as tie from h
), s as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as rank from k group by source
), w as (
  select *, 2 * source_size as lim, case rank % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight from s
), f as (
  select *, row_number() over (order by lim / weight, rank) as place,
    coalesce(sum(lim) over (order by lim / weight, rank rows between unbounded preceding and 1 preceding), 0)::double as full_before,
    coalesce(sum(weight) over (order by lim / weight, rank rows between unbounded preceding and 1 preceding), 0)::double as gone,
    sum(weight) over () as weights, 1.5::double * (sum(source_size) over ())::double as budget from w
), l as (select *, (budget - full_before) / (weights - gone) as level from f
), x as (select min(place) as place, arg_min(level, place) as level from l where lim / weight > level
), t as (
  select l.source, l.source_size, case when x.place is null or l.place < x.place then l.lim::double else l.weight * x.level end as target from l left join x on true
), e as (
  select *, case when source_size > 0 then least(floor(floor(target) / source_size), 2)::bigint else 0 end as epochs from t
), c as (
  select k.doc_id, k.size::bigint as size, e.source_size, e.target, e.epochs, k.source, floor(e.target)::bigint - e.epochs * e.source_size as rest,
    coalesce(sum(k.size) over (partition by k.source order by k.key, k.doc_id, k.tie rows between unbounded preceding and 1 preceding), 0)::bigint as passed
  from k join e on k.source is not distinct from e.source
)
select doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - passed)))::bigint as taken, source from c
"""
