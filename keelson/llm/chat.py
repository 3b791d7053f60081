"""Chat formatting as prefix trees: conversations that share their first turns are merged, shared turns are emitted once.

Every turn is formatted as a segment. The node of a turn stands for the turns of its conversation up to it; two
conversations have a node in common as far as their turns are equal. Nodes of one first turn make up a tree, which is
emitted depth-first: a segment has its start in the tree's text, its position (the code points before it in any conversation
that runs through it), the spans of the tree's text that its own text may attend to besides itself - those of its
ancestors - and the span of it that counts for the loss. Token t of a segment has position id `position + t`.

The steps work on hashes and lengths; texts are joined to the finished order. A node is the exclusive or of the hashes of
(turn, place in the conversation), so it is a running total along a conversation. Conversations are sorted by the choices they
make where a tree branches, which is a depth-first order; the first one in which a node occurs emits it. Running totals are
computed in ranges and joins on shared nodes send hot ones by broadcast, so neither a first turn that a third of
all conversations share nor a conversation with a third of all rows is one task.

Reading back runs down the segments in their order and keeps the state of the digests where the tree branches, so a shared turn
is read once too. A shard that begins inside a tree names the segments above its first one, and those are read again.

Defined results: rows stand by turn (null first); rows with equal turns stand by a hash of role and text, repeated rows count
each; null roles and texts are empty; rows without an id are one conversation. Only turns whose role is exactly `assistant` count for
the loss. An empty table gives no rows (the query still has its own conversation -1); further columns are left alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import cut, fresh_dir, table
from keelson.llm.components import BROADCAST_ROWS, hot_join
from keelson.llm.ordered import in_order, part_of, running

START, END, LEARNT = "<|im_start|>", "<|im_end|>", "assistant"


def escaped_text(text: Column) -> Column:
    r"""Without `<|`: it gets one backslash in between, `<\|` gets one more, and so on, which can be undone."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def escaped_role(role: Column) -> Column:
    """Without line feeds and `<`, which end the role and begin a mark."""
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("<"), F.lit("\\l"))


def plain_text(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def plain_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "l": "<"}.get(m[1], m[1]), role)


def segment(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escaped_role(role), F.lit("\n"), escaped_text(text), F.lit(f"{END}\n"))


def _turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv (never null), turn, role, text, two hashes and `row`, equal for equal rows only."""
    c = lambda name, kind: F.col(f"`{name}`").cast(kind)
    out = conversations.select(
        F.coalesce(c(conv_col, "long").cast("string"), F.lit("")).alias("conv"), c(turn_col, "long").alias("turn"), F.coalesce(c(role_col, "string"), F.lit("")).alias("role"), F.coalesce(c(text_col, "string"), F.lit("")).alias("text"),
    ).withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64("text", F.lit(1), "role")})
    return out.withColumn("row", F.concat_ws("/", "conv", F.coalesce(F.col("turn").cast("string"), F.lit("-")), F.hex("h1"), F.hex("h2")))


def _hex(a: Column, b: Column) -> Column:
    return F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0"))


def _along(turns: DataFrame) -> DataFrame:
    """Every row with its place k in the conversation, at (code points before it), n (its own), node, parent ('' above the first turn) and choice."""
    size = F.char_length(segment(F.col("role"), F.col("text"))).cast("long")
    placed = in_order(turns.select("conv", "turn", "h1", "h2", "row", size.alias("n")), "conv", "turn", "h1", "h2")
    rows = running(placed, "conv", F.sum, lambda a, b: a + b, k=F.lit(1).cast("long"), end=F.col("n"))
    rows = rows.withColumns({"t1": F.xxhash64("h1", "h2", "k"), "t2": F.xxhash64("k", "h2", "h1")})
    rows = running(rows, "conv", F.bit_xor, lambda a, b: a.bitwiseXOR(b), p1=F.col("t1"), p2=F.col("t2"))
    parent = F.when(F.col("k") > 1, _hex(F.col("p1").bitwiseXOR(F.col("t1")), F.col("p2").bitwiseXOR(F.col("t2")))).otherwise("")
    return cut(rows.select("conv", "row", "k", "n", (F.col("end") - F.col("n")).alias("at"), _hex(F.col("p1"), F.col("p2")).alias("node"), parent.alias("parent"), F.struct("k", "t1", "t2").alias("choice")))


def write_trees(conversations: DataFrame, path: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> None:
    """Writes path/segments and path/conversations.

    segments: tree, start, position, n_chars, text, loss_start, loss_chars (within text), attends (spans of the tree's text),
    node, k, branches and ends (whether several turns or none follow in some conversation), shard, rank, and context (starts of the segments above) on a
    shard's first segment. conversations: conv_id, tree, node (its last one), n_turns.
    """
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col)
    rows = _along(turns)
    n_rows = rows.count()

    forks = cut(rows.where("parent <> ''").select("parent", "node").distinct().groupBy("parent").count().where("count > 1").select("parent"))
    chosen = hot_join(rows, "parent", forks, n_rows, forks.count()).groupBy("conv").agg(F.sort_array(F.collect_list("choice")).alias("path"))
    convs = rows.groupBy("conv").agg(F.max("k").alias("n_turns"), F.min_by("node", "k").alias("tree"), F.max_by("node", "k").alias("node")).join(chosen, "conv", "left")
    convs = in_order(convs.withColumn("path", F.coalesce("path", F.array().cast(chosen.schema["path"].dataType))), "tree", "path", "n_turns", "conv").withColumnRenamed("place", "rank").drop("path")
    rows = cut(hot_join(rows, "conv", convs.select("conv", "tree", "rank"), n_rows, convs.count()))

    # the first conversation with a node emits it; what a conversation emits, its run, is the end of its turns
    nodes = rows.groupBy("node").agg(F.min(F.struct("rank", "k", "at", "n", "row", "tree")).alias("x")).select("node", "x.*")
    runs = nodes.groupBy("rank").agg(F.first("tree").alias("tree"), F.min("k").alias("first_k"), F.min("at").alias("head"), F.sum("n").alias("length"))
    runs = running(runs.withColumnRenamed("rank", "place"), "tree", F.sum, lambda a, b: a + b, through=F.col("length")).withColumnRenamed("place", "rank")
    runs = cut(runs.select("rank", "first_k", "head", (F.col("through") - F.col("length")).alias("run_start")))
    nodes = cut(nodes.join(runs, "rank").withColumn("start", F.col("run_start") + F.col("at") - F.col("head")).drop("head"))

    above = rows.join(runs.where("first_k > 1").select("rank", "first_k"), "rank").where("k < first_k").select("rank", "node")
    above = hot_join(above, "node", nodes.select("node", F.col("rank").alias("from"), "start", "n"), n_rows, nodes.count())
    spans = above.groupBy("rank", "from").agg(F.min("start").alias("a"), F.max(F.col("start") + F.col("n")).alias("z"))
    spans = spans.groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("a", "z"))).alias("spans"))
    first = runs.groupBy(part_of("rank").alias("shard")).agg(F.min("rank").alias("rank")).select("rank")  # a row for each range
    context = above.join(F.broadcast(first), "rank", "left_semi").groupBy("rank").agg(F.sort_array(F.collect_list("start")).alias("context"))
    marks = forks.select(F.col("parent").alias("node"), F.lit(True).alias("branches"), F.lit(False).alias("ends")).unionByName(convs.select("node", F.lit(False).alias("branches"), F.lit(True).alias("ends")))
    marks = marks.groupBy("node").agg(F.bool_or("branches").alias("branches"), F.bool_or("ends").alias("ends"))

    out = nodes.join(spans, "rank", "left").join(context, "rank", "left").join(marks, "node", "left")
    own = F.when(F.col("start") > F.col("run_start"), F.array(F.struct(F.col("run_start").alias("a"), F.col("start").alias("z"))))
    none = F.array().cast("array<struct<a:bigint,z:bigint>>")
    texts = turns.select("row", "role", "text").dropDuplicates(["row"])  # repeated rows have one text and several nodes
    head = F.char_length(escaped_role(F.col("role"))) + len(START) + 1
    learnt = F.col("role") == LEARNT
    out = out.join(texts, "row").select(
        "tree", "start", F.col("at").alias("position"), F.col("n").alias("n_chars"), segment(F.col("role"), F.col("text")).alias("text"),
        F.when(learnt, head).otherwise(0).cast("long").alias("loss_start"), F.when(learnt, F.char_length(escaped_text(F.col("text")))).otherwise(0).cast("long").alias("loss_chars"),
        F.concat(F.coalesce("spans", none), F.coalesce(own, none)).alias("attends"), "node", "k", F.coalesce("branches", F.lit(False)).alias("branches"), F.coalesce("ends", F.lit(False)).alias("ends"),
        part_of("rank").alias("shard"), "rank", F.when(F.col("k") == F.col("first_k"), F.col("context")).alias("context"),
    )
    out.repartition("shard").sortWithinPartitions("shard", "rank", "k").write.parquet(f"{path}/segments")  # a shard is a range of ranks
    convs.select(F.when(F.col("conv") != "", F.col("conv")).cast("long").alias("conv_id"), "tree", "node", "n_turns").write.parquet(f"{path}/conversations")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments by shard and depth-first (shard, k, branches, ends, node, text, loss_start, loss_chars) to the digests of the nodes at which a conversation ends."""
    shard, last, kept = None, (0, None), {}
    for b in batches:
        out = []
        for s, k, branches, ends, node, text, loss_start, loss_chars in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if s != shard:
                shard, last, kept = s, (0, None), {}
            if k == 1:
                turns, loss, n_loss, n_chars, kept = hashlib.sha256(), hashlib.sha256(), 0, 0, {}
            elif last[0] == k - 1:  # the turn before is the one just read
                turns, loss, n_loss, n_chars = last[1]
            else:
                kept = {d: x for d, x in kept.items() if d < k}
                turns, loss, n_loss, n_chars = kept[k - 1]
                turns, loss = turns.copy(), loss.copy()
            role, _, rest = text.removeprefix(START).partition("\n")
            turns.update(f"{plain_role(role)}\n{plain_text(rest.removesuffix(f'{END}\n'))}\n".encode())
            learnt = plain_text(text[loss_start : loss_start + loss_chars])
            loss.update(learnt.encode())
            state = (turns, loss, n_loss + len(learnt), n_chars + len(text))
            last = (k, state)
            if branches:
                kept[k] = (turns.copy(), loss.copy(), *state[2:])
            if ends:
                out.append((node, k, turns.hexdigest(), state[2], loss.hexdigest(), state[3]))
        yield pa.RecordBatch.from_pylist([dict(zip(_DIGESTS.names, x, strict=True)) for x in out], _DIGESTS)


_DIGESTS = pa.schema([("node", pa.string()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every conversation, from the written segments."""
    written = spark.read.parquet(f"{path}/segments")
    segments = written.select("shard", F.col("rank").alias("order"), "k", "branches", "ends", "node", "text", "loss_start", "loss_chars")
    above = written.where("context is not null").select("tree", F.col("shard").alias("to"), F.explode("context").alias("start"))
    small = above.count() <= BROADCAST_ROWS
    above = written.drop("shard").join(F.broadcast(above) if small else above, ["tree", "start"]).select(
        F.col("to").alias("shard"), F.lit(-1).cast("long").alias("order"), "k", F.lit(True).alias("branches"), F.lit(False).alias("ends"), "node", "text", "loss_start", "loss_chars")
    ordered = segments.unionByName(above).repartition("shard").sortWithinPartitions("shard", "order", "k").drop("order")
    names = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'string'}" for f in _DIGESTS)
    digests = cut(ordered.mapInArrow(_digests, names))
    convs = cut(spark.read.parquet(f"{path}/conversations").select("conv_id", "node"))
    return hot_join(convs, "node", digests, convs.count(), digests.count()).drop("node")


#: The conversation that the query adds: both texts are made of control strings.
TRIAL = f"{END}{START}{LEARNT} ok"


def op12_chat(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, written as trees and read back."""
    trial = spark.createDataFrame([(-1, 0, "user", TRIAL), (-1, 1, LEARNT, TRIAL)], "conv_id long, turn long, role string, text string")
    path = fresh_dir(spark, "chat")
    write_trees(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(trial), path)
    return read_digests(spark, path)


SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok'),
f AS (SELECT *, 24 + length(replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<', '\l')) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(n)::BIGINT AS formatted_chars FROM f GROUP BY conv_id
"""
