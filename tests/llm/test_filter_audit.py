"""The filter audit against plain Python, on nulls, empty tables, repeats, long texts and clashing columns."""

import collections
import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from keelson.llm import filter_audit
from tests.llm.test_operators import ROUGH, SCHEMA, clash

LABELS = "doc_id long, quality int, toxic int"


def plain_audit(docs, labels):
    """Rows of (part, order, step, seven counts); docs: (doc_id, text, lang, source, n_chars)."""
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    first = {}
    for d, t, *_ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    parts = collections.defaultdict(list)
    for d, t, _, source, _ in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and first[t] < d,
        }
        parts[source or ""].append((d, {k for k, v in failed.items() if v}))
    out, shapley = [], collections.Counter()
    for part, rows in parts.items():
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order):
                gone = lambda f: f & set(order[:step])  # noqa: B023, E731
                removed = [d for d, f in rows if letter in f and not gone(f)]
                shapley[part, letter] += len(removed)
                kept = sum(not gone(f) and letter not in f for _, f in rows)
                redundant = sum(letter in f and bool(gone(f)) for _, f in rows)
                out.append((part, "".join(order), step + 1, kept, len(removed), redundant, sum(f == {letter} for _, f in rows), sum(d in good for d in removed), sum(d in toxic for d in removed)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def audited(spark, docs, labels):
    letters = "".join(filter_audit.text_filters()) + filter_audit.COPY
    ids = labels.select(F.col("doc_id").alias("id"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))
    return filter_audit.filter_audit(filter_audit.failure_masks(docs), letters, ids)


def make(seed, n=80):
    rnd = random.Random(seed)
    kinds = [lambda: " ".join(f"w{rnd.randrange(400)}" for _ in range(260)), lambda: "Aa Bb " * 150, lambda: "short text", lambda: " ".join(f"x{rnd.randrange(60)}#" for _ in range(210)), lambda: "UPPER lower " + "y" * 30]
    docs = [(i, rnd.choice(kinds)(), "l", rnd.choice(["a", "a", "a", "b", None, ""]), 1) for i in range(n)]
    docs += [(n + i, docs[rnd.randrange(n)][1], "l", rnd.choice(["a", "c"]), 1) for i in range(n // 2)]
    return docs


@pytest.mark.parametrize("seed", range(2))
def test_audit(spark, seed):
    docs = make(seed)
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 100, 3)] + [(3, None, 1), (3, 1, None), (None, 1, 1), (999, 1, 1)]
    labels = [(a, b, None if c is None else int(c)) for a, b, c in labels]
    got = audited(spark, clash(spark.createDataFrame(docs, SCHEMA), "part", "mask", "id", "digest", "words", "first", "step"), spark.createDataFrame(labels, LABELS))
    assert sorted(map(tuple, got.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect())) == plain_audit(docs, labels)


def test_edges(spark):
    """Empty tables, rows without ids, repeated rows, a very long text; the sums hold in every order."""
    none = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert audited(spark, *none).count() == 0
    docs = [*ROUGH, (9, "Word " * 300_000, None, "s", 0), (10, "Word " * 300_000, None, "s", 0)]
    got = audited(spark, spark.createDataFrame(docs, SCHEMA), none[1]).collect()
    assert sorted(map(tuple, got)) == plain_audit(docs, [])
    by_order = collections.defaultdict(list)
    for r in got:
        by_order[r["part"], r["filter_order"]].append(r)
    for rows in by_order.values():
        rows.sort(key=lambda r: r["step"])
        total = rows[0]["kept"] + rows[0]["removed"]
        assert all(r["kept"] + sum(x["removed"] for x in rows[: r["step"]]) == total for r in rows)


def test_plan_has_no_join_of_copies_by_text_alone(spark):
    """Copies are found by digest and id, so the copies of one text are dealt out."""
    masks = filter_audit.failure_masks(spark.createDataFrame(make(3), SCHEMA))
    plan = masks._jdf.queryExecution().optimizedPlan().toString()
    join = next(x for x in plan.split("\n") if "Join LeftOuter" in x)
    assert "digest" in join and "id#" in join
