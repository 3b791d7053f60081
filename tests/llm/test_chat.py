"""Chat trees: digests against plain Python, and the written trees themselves."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from keelson.llm import chat
from keelson.llm.common import fresh_dir
from keelson.llm.ordered import in_order, part_of, running
from tests.llm.test_operators import clash

SCHEMA = "conv_id long, turn long, role string, text string"
ODD = [chat.TRIAL, "<|", "<\\|x", "<\\\\|", "\\<|", "<", "|", "", None, "a\nb\n", "<|im_start|>user\nhi<|im_end|>\n", "中é\u0000", "<<||>>"]
ROLES = ["user", "assistant", "assistant", "system", None, "", "a\nb", "<|im_end|>", "\\l\\n<"]


def plain(rows):
    convs = collections.defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t, role or "", text or ""))
    out = []
    for c, turns in convs.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0]))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        learnt = "".join(text for _, role, text in turns if role == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(learnt), sha(learnt)))
    return sorted(out, key=str)


def make(seed, n=120):
    rnd = random.Random(seed)
    rows = []
    stems = [[(rnd.choice(ROLES), rnd.choice(ODD + ["hello there"])) for _ in range(rnd.randrange(1, 7))] for _ in range(5)]
    for c in range(n):
        stem = stems[0 if rnd.random() < 0.5 else rnd.randrange(5)]
        turns = stem[: rnd.randrange(len(stem) + 1)] + [(rnd.choice(ROLES), rnd.choice(ODD + [f"t{rnd.randrange(4)}"])) for _ in range(rnd.randrange(0, 4))]
        rows += [(c, i, *x) for i, x in enumerate(turns)]
    return rows


@pytest.fixture
def scattered(spark):
    """Many small ranges, as on a large table."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def written(spark, rows, *names):
    path = fresh_dir(spark, "chat")
    chat.write_trees(clash(spark.createDataFrame(rows, SCHEMA), *names), path)
    return path


def digests(spark, path):
    return sorted((tuple(r) for r in chat.read_digests(spark, path).collect()), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_digests_and_trees(scattered, seed):
    spark, rows = scattered, make(seed)
    path = written(spark, rows, "conv", "node", "k", "n", "row", "tree", "start", "rank", "place")
    got = digests(spark, path)
    assert [g[:5] for g in got] == plain(rows)
    segments = spark.read.parquet(f"{path}/segments").orderBy("rank", "k").collect()
    assert len({r["shard"] for r in segments}) > 2 and any(r["context"] for r in segments)
    # every prefix of turns is one segment
    convs = collections.defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: r[:2]):
        convs[c].append((role or "", text or ""))
    assert len(segments) == len({tuple(v[: i + 1]) for v in convs.values() for i in range(len(v))})
    # trees are emitted depth-first without gaps, and what a segment attends to is the conversation before it
    trees, by_node = collections.defaultdict(str), {}
    for r in segments:
        assert r["start"] == len(trees[r["tree"]]) and r["n_chars"] == len(r["text"])
        before = "".join(trees[r["tree"]][x["a"] : x["z"]] for x in r["attends"])
        assert r["position"] == len(before)
        trees[r["tree"]] += r["text"]
        by_node[r["node"]] = before + r["text"]
    seen = {r["conv_id"]: by_node[r["node"]] for r in spark.read.parquet(f"{path}/conversations").collect()}
    escape = lambda t: __import__("re").sub(r"<(\\*)\|", r"<\1\\|", t)
    role = lambda x: x.replace("\\", "\\\\").replace("\n", "\\n").replace("<", "\\l")
    assert seen == {c: "".join(f"<|im_start|>{role(a)}\n{escape(b)}<|im_end|>\n" for a, b in v) for c, v in convs.items()}
    assert {g[0]: g[5] for g in got} == {c: len(t) for c, t in seen.items()}


def test_escapes(spark):
    df = spark.createDataFrame([(t or "", r or "") for t in ODD for r in ROLES], "t string, r string")
    for t, r, et, er in df.select("t", "r", chat.escaped_text(F.col("t")), chat.escaped_role(F.col("r"))).collect():
        assert "<|" not in et and "<" not in er and "\n" not in er and chat.plain_text(et) == t and chat.plain_role(er) == r


def test_edges(spark):
    """Empty tables, nulls in any column, repeated rows and turns, a very long text, either order of rows."""
    assert digests(spark, written(spark, [])) == []
    rough = [(None, None, None, None), (None, 1, "assistant", None), (7, 0, "user", "x"), (7, 1, "assistant", "y"), (7, 1, "assistant", "y"), (8, None, "assistant", "z"), (8, 0, None, "w"), (9, 0, "user", "long " * 400_000), (9, 1, "assistant", "<|" * 300_000)]
    for rows in (rough, rough[::-1]):
        assert [g[:5] for g in digests(spark, written(spark, rows))] == plain(rough)
    ties = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "c")]
    assert digests(spark, written(spark, ties)) == digests(spark, written(spark, ties[::-1]))


def test_many_share_a_turn_and_one_is_long(scattered):
    """A hot first turn, thousands of equal conversations, a conversation with a third of all rows."""
    spark = scattered
    rows = [(c, i, r, t) for c in range(1500) for i, (r, t) in enumerate([("user", "same"), ("assistant", f"answer {c % 50}")])]
    rows += [(-5, i, "assistant" if i % 2 else "user", f"turn {i}" if i else "same") for i in range(1500)]
    path = written(spark, rows)
    assert [g[:5] for g in digests(spark, path)] == plain(rows)
    assert spark.read.parquet(f"{path}/segments").count() == 1 + 50 + 1499


def test_running_totals_over_ranges(scattered):
    spark = scattered
    rows = [(("hot" if i % 3 else f"g{i % 7}"), i, i * i) for i in range(600)]
    placed = in_order(spark.createDataFrame(rows, "g string, i long, v long"), "g", "i")
    assert placed.select(part_of("place")).distinct().count() > 3
    got = running(placed, "g", F.sum, lambda a, b: a + b, n=F.lit(1).cast("long"), total=F.col("v")).collect()
    n, total = collections.Counter(), collections.Counter()
    for r in sorted(got, key=lambda r: (r["g"], r["i"])):
        n[r["g"]] += 1
        total[r["g"]] += r["v"]
        assert (r["n"], r["total"]) == (n[r["g"]], total[r["g"]])
    assert len(got) == 600
