"""Filter interaction audit: what each of several filters removes, alone and behind the others, in every order.

Every document shrinks to a mask, one bit for each filter that it fails, and documents shrink to cells: counts by part and
mask. The cells are unpivoted against the steps of all orders into a long form; along the steps of an order a running
bit-or over the window says which filters an earlier step has applied to the cell, and conditional sums over the long form
give the metrics. A window over all orders of a filter totals what it removes.

Text features are JVM expressions. Whether a text is a copy is decided by the smallest id of its SHA-256 (combined before
the shuffle) and an equi-join by digest and id, so copies of one text meet in no task. A long form has
2^filters x orders x filters rows for a part at most, whatever the number of documents.

Defined results: a null text is the empty text, a null or empty part is the part ''. A row without an id is no copy and
nobody's original, and has no labels; rows that repeat an id with one text are not copies of each other. An id with several
label rows has a label that any of them gives. An empty table gives no rows; further columns are left alone.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import cut, table, words

#: The filter that is decided by the other rows of the table; all others look at the text alone.
COPY = "E"
#: Failure conditions of the contract.
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT, MARKS = 200, 50, 2, "[#$%&*|]"


def text_filters() -> dict[str, Column]:
    """Failure by letter, over the columns text, words, and n (code points)."""
    n_words = F.size("words")
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    return {
        "A": n_words < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct("words")) < LEAST_DISTINCT_PERCENT * n_words,
        "C": 100 * capitals > MOST_CAPITALS_PERCENT * F.col("n"),
        "D": F.col("text").rlike(MARKS),
    }


def failure_masks(docs: DataFrame, filters: dict[str, Column] | None = None, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """part, id, mask: one row per document. Bit i is the i-th text filter, the highest bit says copy of a smaller id's text."""
    filters = text_filters() if filters is None else filters
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    rows = rows.select("part", "id", F.unhex(F.sha2("text", 256)).alias("digest"), "text", words(F.col("text")).alias("words"), F.char_length("text").alias("n"))
    mask = sum((F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(filters.values())), F.lit(0))
    rows = cut(rows.select("part", "id", "digest", mask.cast("int").alias("mask")))
    first = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    # by digest and id: of a text with very many copies one row finds its partner, and the others are dealt out by id
    copy = F.when(F.col("id").isNotNull() & F.col("first").isNull(), 1 << len(filters)).otherwise(0)
    return rows.join(first, ["digest", "id"], "left").select("part", "id", (F.col("mask") + copy).alias("mask"))


def filter_audit(masks: DataFrame, letters: str, labels: DataFrame | None = None) -> DataFrame:
    """The metrics of every part, order and step. masks: part, id, mask; bit i of a mask is the filter letters[i]; labels: id, good, toxic (booleans)."""
    good, toxic = F.lit(False), F.lit(False)
    if labels is not None:
        one = labels.where(F.col("id").isNotNull() & (F.col("good") | F.col("toxic"))).groupBy("id").agg(F.bool_or("good").alias("good"), F.bool_or("toxic").alias("toxic"))
        masks = masks.join(one, "id", "left")
        good, toxic = F.coalesce(F.col("good"), F.lit(False)), F.coalesce(F.col("toxic"), F.lit(False))
    cells = masks.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if(good).alias("n_good"), F.count_if(toxic).alias("n_toxic"))

    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    steps = F.sequence(F.lit(1), F.lit(len(letters)))
    long = cells.withColumn("filter_order", F.explode(orders))
    # one exchange serves the windows by cell and order and the sums by part, order and step
    long = long.repartition("part", "filter_order").withColumn("step", F.explode(steps))
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    long = long.withColumn("letter", letter).withColumn("bit", F.call_function("shiftleft", F.lit(1), F.instr(F.lit(letters), F.col("letter")) - 1))
    earlier = Window.partitionBy("part", "filter_order", "mask").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    long = long.withColumn("gone", F.coalesce(F.bit_or(F.col("bit").bitwiseAND(F.col("mask"))).over(earlier), F.lit(0)) != 0).withColumn("fails", fails)

    def total(condition: Column, of: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(of)).otherwise(F.lit(0))).cast("long")

    removed = F.col("fails") & ~F.col("gone")
    out = long.groupBy("part", "filter_order", "step", "letter").agg(
        total(~F.col("fails") & ~F.col("gone")).alias("kept"), total(removed).alias("removed"), total(F.col("fails") & F.col("gone")).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(removed, "n_good").alias("good_lost"), total(removed, "n_toxic").alias("toxic_lost"),
    )
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter"))).drop("letter")


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    """All documents, five filters and their 120 orders."""
    filters = text_filters()
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))
    return filter_audit(failure_masks(table(spark, sf_dir, "documents"), filters), "".join(filters) + COPY, labels)


SQL = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (SELECT doc_id, part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b, 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d, doc_id > min(doc_id) OVER (PARTITION BY text) AS e FROM w),
m AS (SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS failed,
    count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic FROM f LEFT JOIN labels USING (doc_id) GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT l1.x || l2.x || l3.x || l4.x || l5.x AS filter_order FROM l l1, l l2, l l3, l l4, l l5 WHERE len(list_distinct([l1.x, l2.x, l3.x, l4.x, l5.x])) = 5),
s AS (SELECT part, failed, n, good, toxic, filter_order, step, filter_order[step] AS letter, contains(failed, filter_order[step]) AS fails,
    step > 1 AND len(list_intersect(string_split(filter_order[1:step - 1], ''), string_split(failed, ''))) > 0 AS gone FROM m, o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step::INT AS step, letter, coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (failed = letter), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost FROM s GROUP BY ALL)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM r
"""
