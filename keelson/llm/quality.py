"""Quality rules: a few base counts, then the hashed n-gram log-likelihood ratio of a trusted target to the raw corpus.

Texts are cut into runs of letters and digits and runs of other characters; their unigrams and bigrams are hashed to
BUCKETS buckets. One pass counts every bucket over all documents and, alongside, over the target: documents with a good
label. The smoothed log ratio of the two multinomials is the weight of a bucket, rounded to millionths, so that a
document's score, the mean weight of its n-grams, comes from an exact integer sum and thresholding is deterministic.
Only DataFrame functions run; the weights, BUCKETS integers whatever the corpus, are a literal of the scoring plan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import BLANKS, table, words

BUCKETS = 1 << 14
#: A document stays if its mean weight, in nats per n-gram, is at least this. Of the labelled documents of sf0.1 every value
#: from -0.7 to -0.1 keeps the same ones: all 571 bad ones go, and no good one goes by its score.
THRESHOLD = -0.3
#: At most so many labelled documents make up the target; of more, those with the smallest hash of the id.
TARGET_ROWS = 20_000
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 50, 50, 3
SCALE = 1_000_000


def with_grams(rows: DataFrame, text: Column) -> DataFrame:
    """rows with a column grams: the buckets of all unigrams and bigrams of the text. Tokens are hashed once, bigrams from the hashes."""
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"[\p{{L}}\p{{N}}]+|[^{BLANKS}\p{{L}}\p{{N}}]+"), F.lit(0))
    rows = rows.withColumn("hashes", F.transform(tokens, lambda x: F.xxhash64(x)))
    h, mask = F.col("hashes"), F.lit(BUCKETS - 1)
    one = F.transform(h, lambda x: x.bitwiseAND(mask))
    two = F.transform(F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0))), lambda x, i: F.xxhash64(F.get(h, i), x).bitwiseAND(mask))
    return rows.withColumn("grams", F.concat(one, two)).drop("hashes")


def target_ids(labels: DataFrame, id_col: str = "doc_id", good: Column | None = None, rows: int = TARGET_ROWS) -> DataFrame:
    """The ids of the trusted target, `rows` at most."""
    good = F.col("quality") == 1 if good is None else good
    return labels.where(good & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("target_id")).distinct().orderBy(F.xxhash64("target_id"), "target_id").limit(rows)


def bucket_weights(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[int]:
    """Millionths of log(target share / corpus share), add-one smoothed, by bucket; zeros without a target."""
    texts = with_grams(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), F.col("text")).drop("text")
    marked = texts.join(F.broadcast(target), F.col("doc_id") == F.col("target_id"), "left")
    # outer: a plain explode infers a filter on the array, which pushed down computes it again, inside its own lambdas
    grams = marked.select(F.explode_outer("grams").alias("bucket"), F.when(F.col("target_id").isNotNull(), 1).otherwise(0).alias("t"))
    raw, mine = [0] * BUCKETS, [0] * BUCKETS
    for r in grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("t")).collect():  # BUCKETS + 1 rows at most
        if r["bucket"] is not None:
            raw[r["bucket"]], mine[r["bucket"]] = r["n"], r["t"]
    n, m = sum(raw) + BUCKETS, sum(mine) + BUCKETS
    if m == BUCKETS:
        return [0] * BUCKETS
    return [round(SCALE * (math.log((b + 1) / m) - math.log((a + 1) / n))) for a, b in zip(raw, mine, strict=True)]


def with_repeated_words(rows: DataFrame, w: str = "w") -> DataFrame:
    """rows with n_repeat_words: how many words of the array w stand in a WINDOW-word window that occurs twice or more.

    Windows sorted by hash stand next to their equals; the positions of those that have one are merged to a union of
    intervals. Hashes of 64 bits are compared, within one text only. Each step is a column of its own, so that lambdas
    refer to a value and not to an expression; texts without a repeated window skip the sort.
    """
    x = F.col(w)
    windows = F.transform(F.slice(x, 1, F.greatest(F.size(x) - (WINDOW - 1), F.lit(0))), lambda a, i: F.xxhash64(a, F.get(x, i + 1), F.get(x, i + 2)))
    rows = rows.withColumn("windows", windows)
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("placed", F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))
    s = F.col("placed")
    twice = F.filter(s, lambda v, i: F.coalesce(v["h"] == F.get(s, i - 1)["h"], F.lit(False)) | F.coalesce(v["h"] == F.get(s, i + 1)["h"], F.lit(False)))
    starts = F.sort_array(F.transform(twice, lambda v: v["p"]))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    union = F.aggregate(starts, zero, lambda acc, p: F.struct((acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).alias("n"), (p + WINDOW).alias("end")), lambda acc: acc["n"])
    return rows.withColumn("n_repeat_words", F.coalesce(union, F.lit(0)).cast("long")).drop("windows", "placed")


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", " ")) != "")
    out = with_repeated_words(docs.withColumns({"w": words(F.col(text_col)), "lines": lines}))
    return out.withColumns(
        {
            "n_words": F.size("w").cast("long"),
            "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        }
    ).drop("w", "lines")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, target_rows: int = TARGET_ROWS, whole: bool = False) -> DataFrame:
    """doc_id, the base counts, base_failed, score and kept for every row.

    base_failed: fewer than 50 words, or over half of the words in repeated three-word windows. score: the mean weight
    of the text's n-grams, 0 for a text without any. kept: not base_failed and score >= threshold. Null texts are empty
    and so fail; null and repeated ids are ordinary rows. Without good labels all weights are 0 and the base decides.
    An empty table gives an empty result. whole adds
    the input row as a struct column `row`, where its columns can't clash with any of these.
    """
    weights = bucket_weights(docs, target_ids(labels, id_col, rows=target_rows), id_col, text_col)
    table_ = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")  # folded to a literal
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole else []), F.col(text_col).cast("string").alias("text"))
    rows = with_grams(base_counts(rows), F.col("text")).drop("text")
    total = F.aggregate("grams", F.lit(0).cast("long"), lambda a, b: a + F.get(table_, b.cast("int")))
    score = F.coalesce(total / F.nullif(F.size("grams"), F.lit(0)) / F.lit(float(SCALE)), F.lit(0.0))
    # a row number is never negative, but as it isn't deterministic it keeps a filter on `kept` above these columns: pushed
    # below, the filter would hold each of them many times over
    verdict = ~F.col("base_failed") & (F.col("score") >= threshold) & (F.monotonically_increasing_id() >= 0)
    return rows.withColumn("base_failed", base_failed()).withColumn("score", score).withColumn("kept", verdict).drop("grams")


def op3_quality(spark, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def keep_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs that the rules keep, unchanged; the corpus statistics are those of docs."""
    return quality(docs, labels, whole=True, **options).where("kept").select("row.*")


def quality_base_counts(spark, sf_dir: str) -> DataFrame:
    """The part of the rules that SQL can state: base counts and base_failed of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = base_counts(docs).withColumn("base_failed", base_failed())
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


BASE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, i, hash(w[i], w[i + 1], w[i + 2]) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g),
p AS (SELECT r, count(DISTINCT i + k)::BIGINT AS n_repeat_words FROM c CROSS JOIN (VALUES (0), (1), (2)) o(k) WHERE n > 1 GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
       length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
       coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed
FROM w LEFT JOIN p USING (r)
"""
