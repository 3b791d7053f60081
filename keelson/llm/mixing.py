"""Mixing sources to target weights along a time-varying curriculum.

Every source has a target number of words. Within a source, documents stand in a seeded random order and their
cumulative sizes are laid on the line [0, target): a first epoch, then a second one where the target exceeds the
source. The source's weight schedule over training time is integrated to a cumulative demand; inverting it gives each
copy its training position in [0, 1). Documents range-sorted by position are the training order.

Cumulative sizes are computed in three levels: coarse ranges of the random key, ranges in a coarse one, rows in a range.
Their number grows with the table, so no task holds a whole source. The random key is made of id and text, so neither rows
without an id nor rows that share one are one range. Rows that are equal in all columns are counted, laid as blocks of
ROWS_PER_BLOCK, and told apart again only when the blocks have been dealt out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import cut, free_name, row_key, table

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix as a share of all words, and the most epochs of any source.
SHARE, EPOCHS = 1.5, 2
#: Relative weight in equal phases of training, by the source's rank modulo 3: constant, rising, falling.
SCHEDULES = ((1.0, 1.0, 1.0, 1.0), (0.4, 0.8, 1.2, 1.6), (1.6, 1.2, 0.8, 0.4))
ROWS_PER_RANGE = 2_000
#: Rows equal in all columns that are laid as one.
ROWS_PER_BLOCK = 10_000
SEED = "mix"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, target and rank; one row per source.

    Weights fill up like water: with the sources in order of the level at which they are full (epochs x size / weight),
    the first k that are full leave the rest of the words to the others by weight. All in window functions over the
    table of sources, which one task sorts: a row per source.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.lit(float(epochs)) * F.col("source_size")).withColumn("level", F.col("cap") / F.col("weight"))
    order = Window.orderBy("level", "rank")
    everything = Window.partitionBy()
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        ranked.withColumn("full_before", F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything))
        # the water level if this source and all behind it stay below their caps
        .withColumn("water", (F.col("total") - F.col("full_before")) / F.col("weight_left"))
        # levels rise along the order, so the sources that are not full are a suffix; the first of it sets the level
        .withColumn("open", F.col("water") <= F.col("level"))
    )
    filled = filled.withColumn("set", F.first(F.when(F.col("open"), F.col("water")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("set").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("set") * F.col("weight")))
    return filled.select("source", "source_size", target.alias("target"), "rank")


def position_of(demand: Column, schedule) -> Column:
    """The time in [0, 1) at which a source with this schedule has given the share `demand` of its target.

    In phase i of n the cumulative demand rises at a constant rate from the weights before it; inside, time is linear in it.
    """
    n, total, given = len(schedule), sum(schedule), 0.0
    phases = []
    for i, w in enumerate(schedule):
        if w:
            phases.append((given + w / total, F.lit(i / n) + (demand - F.lit(given)) * F.lit(total / w / n)))
        given += w / total
    out = phases[-1][1]
    for end, at in reversed(phases[:-1]):
        out = F.when(demand < F.lit(end), at).otherwise(out)
    return F.least(out, F.lit(1.0 - 2.0**-53))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, schedules=SCHEDULES, rows_per_range: int = ROWS_PER_RANGE, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """doc_id, row_key, nth, size, source_size, target, taken and copies (array of copy, take_words, position), one row per document row.

    A document's size is its number of words (null text: 0). The last document that a source gives may be taken in
    part, so that every source gives its target, rounded, exactly; nothing is taken more than `epochs` times. Rows
    that are equal in all columns are told apart by nothing but may get different shares; nth
    numbers them from 0, and the multiset of results is the same on every run. Null ids and null sources are values like any other. An empty table gives an empty plan.
    """
    size = F.expr(f"regexp_count(coalesce(`{text_col}`, ''), '[^\\\\x20\\\\x09-\\\\x0D]+')").cast("long")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    order = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), F.md5(text)))
    sized = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), row_key(docs).alias("row_key"), size.alias("size"), order.alias("order"))
    equal = sized.groupBy(*sized.columns).agg(F.count(F.lit(1)).alias("equal"))
    rows = equal.withColumn("block", F.explode(F.sequence(F.lit(0), F.expr(f"(equal - 1) div {rows_per_block}"))))
    rows = cut(rows.withColumn("rows", F.least(F.lit(rows_per_block), F.col("equal") - F.col("block") * rows_per_block)).drop("equal"))
    n = rows.count()
    digits = 1
    while digits < 7 and n > rows_per_range * 16**digits:
        digits += 1
    rows = rows.withColumn("range", F.substring("order", 1, digits))
    targets = source_targets(rows.select("source", (F.col("size") * F.col("rows")).alias("size")), weights, share, epochs)
    ranges = rows.groupBy("source", "range").agg(F.sum(F.col("size") * F.col("rows")).alias("range_size"))
    # coarse ranges of a source are 4096 at most, ranges of a coarse one 65,536
    ranges = ranges.withColumn("coarse", F.substring("range", 1, digits // 2))
    before = lambda *keys: Window.partitionBy("source", *keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    coarse = ranges.groupBy("source", "coarse").agg(F.sum("range_size").alias("coarse_size"))
    coarse = coarse.select(F.col("source").alias("c_source"), F.col("coarse").alias("c_coarse"), F.coalesce(F.sum("coarse_size").over(before("coarse")), F.lit(0)).alias("coarse_start"))
    ranges = ranges.withColumn("fine_start", F.coalesce(F.sum("range_size").over(before("coarse", "range")), F.lit(0)))
    ranges = ranges.join(coarse, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("coarse") == F.col("c_coarse")))
    ranges = ranges.select("source", "range", (F.col("coarse_start") + F.col("fine_start")).alias("range_start"))
    t = targets.withColumnRenamed("source", "t_source")
    ranges = ranges.join(t, F.col("source").eqNullSafe(F.col("t_source"))).select(F.col("source").alias("r_source"), F.col("range").alias("r_range"), "range_start", "source_size", "target", "rank")
    inside = Window.partitionBy("source", "range").orderBy("order", "doc_id", "size", "row_key", "block").rowsBetween(Window.unboundedPreceding, -1)
    laid = rows.withColumn("inner", F.coalesce(F.sum(F.col("size") * F.col("rows")).over(inside), F.lit(0)))
    laid = laid.join(ranges, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("range") == F.col("r_range")))
    laid = laid.repartition("row_key", "block").withColumn("in_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
    laid = laid.withColumn("nth", F.col("block") * rows_per_block + F.col("in_block"))
    laid = laid.withColumn("start", F.col("range_start") + F.col("inner") + F.col("in_block") * F.col("size")).withColumn("quota", F.round("target").cast("long"))
    copies = []
    for c in range(epochs):
        at = F.col("start") + F.lit(c) * F.col("source_size")
        take = F.greatest(F.lit(0), F.least(F.col("size"), F.col("quota") - at))
        demand = at / F.nullif(F.col("quota"), F.lit(0))
        spot = None
        for i, s in enumerate(schedules):
            spot = F.when(F.col("rank") % len(schedules) == i, position_of(demand, s)) if spot is None else spot.when(F.col("rank") % len(schedules) == i, position_of(demand, s))
        copies.append(F.struct(F.lit(c).alias("copy"), take.alias("take_words"), spot.alias("position")))
    laid = laid.withColumn("copies", F.filter(F.array(*copies), lambda x: x["take_words"] > 0))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda a, x: a + x["take_words"])
    return laid.select("doc_id", "row_key", "nth", "size", "source_size", "target", taken.alias("taken"), "copies")


def position_at(copy: int) -> Column:
    """The training position of a document's n-th copy (from 0), null where the mix takes none."""
    return F.get("copies", F.lit(copy))["position"]


def mix(docs: DataFrame, id_col: str = "doc_id", with_position: bool = False, **options) -> DataFrame:
    """The mixed corpus: the columns of docs, a row for every copy that the plan takes, range-sorted by training position.

    A document that its source's quota cuts stays whole here. Documents without words are never drawn. with_position adds
    the position as a double column `position` (with underscores where docs has one): files alone don't keep an order.
    """
    key, spot, plans = (free_name(docs, x) for x in ("row_key", "position", "copies"))
    # rows that are equal in all columns share a key: their copies all meet one of them, in a join that AQE splits
    plan = plan_mix(docs, id_col, **options).select(F.col("row_key").alias(key), F.explode("copies").alias(plans))
    keyed = docs.withColumn(key, row_key(docs)).dropDuplicates([key])
    out = keyed.join(plan, key).withColumn(spot, F.col(plans)["position"])
    out = out.repartitionByRange(F.col(spot), F.col(key)).sortWithinPartitions(spot, key, F.col(plans)["copy"])
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *([spot] if with_position else []))


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """position and position_again: where in training, from 0 to 1, the document's first and second copy stand."""
    plan = plan_mix(table(spark, sf_dir, "documents"))
    spot = F.coalesce(position_at(0), F.lit(1.0))  # those not drawn come last
    out = plan.withColumn("spot", spot).repartitionByRange("spot", "row_key", "nth").sortWithinPartitions("spot", "row_key", "nth")
    return out.select("doc_id", "size", "source_size", "target", "taken", position_at(0).alias("position"), position_at(1).alias("position_again"))


def _position_sql(demand: str) -> str:
    """position_of() for all schedules in SQL, the same operations in the same order."""
    number = lambda x: f"CAST('{x!r}' AS DOUBLE)"
    out = []
    for k, schedule in enumerate(SCHEDULES):
        n, total, given, phases = len(schedule), sum(schedule), 0.0, []
        for i, w in enumerate(schedule):
            phases.append((given + w / total, f"{number(i / n)} + ({demand} - {number(given)}) * {number(total / w / n)}"))
            given += w / total
        cases = " ".join(f"WHEN {demand} < {number(end)} THEN {at}" for end, at in phases[:-1])
        out.append(f"WHEN {k} THEN least(CASE {cases} ELSE {phases[-1][1]} END, {number(1.0 - 2.0**-53)})")
    return f"CASE rank % {len(SCHEDULES)} {' '.join(out)} END"


SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5(concat('mix:', coalesce(doc_id::VARCHAR, 'null'), ':', md5(coalesce(text, '')))) AS ord
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank FROM d GROUP BY source),
l AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][(rank % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
f AS (SELECT *, cap / weight AS level, 1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM s) AS total FROM l),
g AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY level, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
      sum(weight) OVER (ORDER BY level, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left FROM f),
w AS (SELECT *, (total - full_before) / weight_left AS water FROM g),
o AS (SELECT arg_min(water, (level, rank)) AS level_set FROM w WHERE water <= level),
t AS (SELECT source, source_size, rank, CASE WHEN level_set IS NULL THEN cap ELSE least(cap, level_set * weight) END AS target FROM w CROSS JOIN o),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.rank, round(t.target)::BIGINT AS quota,
      coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, greatest(0, least(size, quota - start)) AS one, greatest(0, least(size, quota - start - source_size)) AS two,
      start::DOUBLE / nullif(quota, 0) AS at_one, (start + source_size)::DOUBLE / nullif(quota, 0) AS at_two FROM p),
r AS (SELECT *, CASE WHEN one > 0 THEN {_position_sql('at_one')} END AS p_one, CASE WHEN two > 0 THEN {_position_sql('at_two')} END AS p_two FROM q)
SELECT doc_id, size, source_size, target, (one + two)::BIGINT AS taken, coalesce(p_one, p_two) AS position, CASE WHEN one > 0 THEN p_two END AS position_again
FROM r
"""
