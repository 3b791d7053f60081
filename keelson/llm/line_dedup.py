"""Line dedup by a segment-partition edit join, in DataFrame functions only.

Equal lines are grouped by a 128-bit hash. Distinct lines are joined by edit distance: each line of length l is cut into
THRESHOLD + 1 segments, and two lines within THRESHOLD edits share at least one segment, shifted by a bounded offset.
So a line puts its segments into an index by (length, segment number, content) and probes it with the substrings that
could be a segment of a line as long as itself or up to THRESHOLD shorter; the offsets worth probing are those for
which the edits left and right of the segment stay within the threshold together. Candidates are verified by a banded bit-parallel
edit distance.

Only hashes travel in the join; texts are fetched for lines that have a candidate. A line's id carries its counts of eight
letters: an edit adds one letter and takes one away at most, so pairs whose counts are further apart never leave the join.

A segment that more than FREQUENT lines have in the index is not joined. What its lines have besides it is at most
THRESHOLD edits apart if the lines are, so it is cut anew, into 3 x THRESHOLD segments of which all but THRESHOLD must be
equal: the key is all of these together, and what remains for a next round, where a key is frequent again, is a
third of the text. So every joined key has few lines in the index and the join grows with the lines, whatever
passage they share. At the end of the rounds all that is left of lines of one length are THRESHOLD characters: all of them are
near each other, as lines with a counter are. What counts is whether an earlier line is near, so they are paired with the earliest of
them only. Lines of other lengths that look for them there are paired when it is known which lines are decided: a pair is
needed only if one of its lines is not, and of the lines with one key at most one is not.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import BLANKS, cut, free_name, row_key, table

THRESHOLD = 2
#: Shorter lines have no part in the edit join: edits would make up too much of them. Equal ones are found at any length.
LEAST_CHARS = 20
#: Ids of candidate lines up to which they are broadcast (16 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Lines with one segment in the index beyond which it is cut anew.
FREQUENT = 64
#: Letters that are counted; which ones matters for speed only.
LETTERS = "enirtaso"
#: More letters, counted where lines share a frequent segment.
MORE_LETTERS = "lduchmgpbvfwkyzj"


def segment_bounds(length: Column, i: int | Column, segments: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment i of a line: as even as can be, the longer ones last."""
    short = F.floor(length / segments).cast("int")
    longer = (length % segments).cast("int")
    first_long = F.lit(segments) - longer
    start = F.lit(i) * short + F.greatest(F.lit(0), F.lit(i) - first_long)
    return start, short + (F.lit(i) >= first_long).cast("int")


def probe_plan(threshold: int) -> list[tuple[int, int, int]]:
    """(how much shorter the indexed line is, its segment, offset of the substring from the segment's start).

    If segment i (from 0) is the first without edits on a best alignment, at most i edits lie before it and at most
    threshold - i behind it; the offset is bounded by both views. The probe for lines of the same length without offset is
    the line's own segment, which stands in the index already.
    """
    out = []
    for shorter in range(threshold + 1):
        for i in range(threshold + 1):
            low, high = max(-i, shorter - (threshold - i)), min(i, shorter + (threshold - i))
            out += [(shorter, i, offset) for offset in range(low, high + 1) if shorter or offset]
    return out


def segment_spans(length: Column, threshold: int, least_chars: int) -> list[tuple[Column, int, Column, Column, Column]]:
    """Of a line's own threshold + 1 segments, then of its probes: length of the indexed line, segment, start and size in the line, whether it fits."""
    n, out = threshold + 1, []
    for i in range(n):
        out.append((length, i, *segment_bounds(length, i, n), F.lit(True)))
    for shorter, i, offset in probe_plan(threshold):
        other = length - shorter
        start, size = segment_bounds(other, i, n)
        at = start + offset
        out.append((other, i, at, size, (other >= least_chars) & (at >= 0) & (at + size <= length)))
    return out


def segment_keys(line: Column, threshold: int, least_chars: int) -> Column:
    """Array of hashes: the line's own threshold + 1 segments, then its probes (null where there is none)."""
    spans = segment_spans(F.char_length(line), threshold, least_chars)
    keys = [(F.xxhash64(other, F.lit(i), F.substring(line, at + 1, size)), fits) for other, i, at, size, fits in spans]
    return F.array(*[key if k <= threshold else F.when(fits, key) for k, (key, fits) in enumerate(keys)])


def without_segment(line: Column, n: Column, threshold: int, least_chars: int) -> Column:
    """The line without what its n-th key was made of."""
    spans = F.array(*[F.struct(at.alias("at"), size.alias("size")) for _, _, at, size, _ in segment_spans(F.char_length(line), threshold, least_chars)])
    span = F.get(spans, n)
    return F.concat(F.left(line, span["at"]), F.substring(line, span["at"] + span["size"] + 1, F.char_length(line)))


def rest_plan(threshold: int) -> list[tuple[bool, int, int, list[int], list[int]]]:
    """(own, how much shorter the indexed text is, number of the choice, skipped segments, offsets behind each of them).

    Edits touch `threshold` of 3 x threshold segments at most; the others stand in the longer text as they are, and the
    offset changes at skipped segments only, in all by no more than the edits.
    """
    out = []
    for number, skipped in enumerate(combinations(range(3 * threshold), threshold)):
        for offsets in product(range(-threshold, threshold + 1), repeat=threshold):
            moves = [z - a for a, z in zip((0, *offsets), offsets, strict=False)]
            # between two neighbours nothing is kept that an offset could tell; the last offset is none to the left, so one will do
            told = threshold != 2 or skipped[1] - skipped[0] > 1 or not offsets[0]
            if offsets[-1] >= 0 and sum(map(abs, moves)) <= threshold and told:
                out.append((not any(offsets), offsets[-1], number, list(skipped), list(offsets)))
    return out


def rest_keys(rows: DataFrame, threshold: int) -> DataFrame:
    """rows (id, place, more, parts, own, group, s) by all choices of skipped segments: id, place, more, parts (longer by the skipped ones), own, key, small (nothing but edits is left), and
    rest, what the key leaves out. A row whose text is not its own, but probes for another's, is no index."""
    kind = "array<struct<own:boolean,shorter:int,number:int,skipped:array<int>,offsets:array<int>>>"
    plan = F.array(*[F.struct(F.lit(o), F.lit(d), F.lit(k), F.array(*map(F.lit, p)), F.array(*map(F.lit, s))) for o, d, k, p, s in rest_plan(threshold)]).cast(kind)
    rows = rows.withColumn("v", F.explode(plan))
    rows = rows.withColumn("length", F.char_length("s") - F.col("v.shorter")).where("length >= 0")
    at, kept, left, fits = F.lit(0), [], [], F.lit(True)
    before = F.lit(0)
    for j in range(threshold):
        start, size = segment_bounds(F.col("length"), F.col("v.skipped")[j], 3 * threshold)
        after = F.col("v.offsets")[j]
        kept.append(F.substring("s", at + 1, start + before - at))
        left.append(F.substring("s", start + before + 1, size + after - before))
        fits = fits & (size + after - before >= 0)
        at, before = start + size + after, after
    kept.append(F.substring("s", at + 1, F.char_length("s")))
    key = F.xxhash64("group", "length", "v.number", *kept)
    # a skipped segment without edits is the choice of one pair only if those behind it are skipped as well: of all choices
    # that fit a pair one remains
    parts = F.array(*[F.when(F.col("v.skipped")[j] < 2 * threshold + j, F.xxhash64(x)) for j, x in enumerate(left)])
    return rows.where(fits).select("id", "place", "more", F.concat("parts", parts).alias("parts"), (F.col("own") & F.col("v.own")).alias("own"), key.alias("key"), (F.col("length") <= threshold).alias("small"), F.concat(*left).alias("rest"))


def letter_counts(line: Column, letters: str) -> Column:
    """The counts of letters modulo 16, four bits each."""
    out = F.lit(0).cast("bigint")
    for k, letter in enumerate(letters):
        n = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))
        out = out.bitwiseOR(F.shiftleft(n.bitwiseAND(F.lit(15)).cast("bigint"), 4 * k))
    return out


def line_id(line: Column, h: Column) -> Column:
    """32 bits of hash and the counts of eight letters. Lines that share an id are told apart by their texts."""
    return h.bitwiseAND(F.lit(-1 << 4 * len(LETTERS))).bitwiseOR(letter_counts(line, LETTERS))


def counts_within(pairs: list[tuple[Column, Column, int]], threshold: int) -> Column:
    """Whether letter counts, given as pairs with the number of letters in them, allow for threshold edits: each adds one
    letter at most and takes one away at most."""
    more, less = [], []
    for a, b, letters in pairs:
        for k in range(letters):
            x, y = (F.shiftrightunsigned(c, 4 * k).bitwiseAND(F.lit(15)) for c in (a, b))
            d = (x - y + 8).bitwiseAND(F.lit(15)) - 8
            more.append(F.greatest(d, F.lit(0)))
            less.append(F.greatest(-d, F.lit(0)))
    return (reduce(Column.__add__, more) <= threshold) & (reduce(Column.__add__, less) <= threshold)


def within_edits(rows: DataFrame, a: str, b: str, threshold: int) -> DataFrame:
    """rows with a column near: whether the strings a and b differ by at most threshold edits.

    Common prefix and suffix are trimmed in steps of powers of two; cores that can't be within threshold are left out. For
    the others one machine word holds the band: after j characters of b, bit k of the word for e errors tells if the first
    j + k - threshold characters of a are within e edits of them. A character shifts the diagonals' words by match,
    substitution, insertion and deletion at once.
    """
    steps = F.array(*[F.lit(1 << k) for k in range(12, -1, -1)])
    n_a, n_b = F.char_length(a), F.char_length(b)
    most = F.least(n_a, n_b)
    alike = lambda x, y, step: F.substring(F.col(a), x, step) == F.substring(F.col(b), y, step)
    head = F.aggregate(steps, F.lit(0), lambda k, step: F.when((k + step <= most) & alike(k + 1, k + 1, step), k + step).otherwise(k))
    rows = rows.withColumn("head", head)
    tail = F.aggregate(steps, F.lit(0), lambda k, step: F.when((F.col("head") + k + step <= most) & alike(n_a - k - step + 1, n_b - k - step + 1, step), k + step).otherwise(k))
    rows = rows.withColumn("tail", tail)
    rows = rows.withColumns({"n_x": n_a - F.col("head") - F.col("tail"), "n_y": n_b - F.col("head") - F.col("tail")})
    rows = rows.withColumns({"x": F.substring(F.col(a), F.col("head") + 1, F.col("n_x")), "y": F.substring(F.col(b), F.col("head") + 1, F.col("n_y"))})
    rows = rows.withColumn("open", (F.abs(F.col("n_x") - F.col("n_y")) <= threshold) & (F.greatest("n_x", "n_y") > threshold) & (F.col("n_y") > 0) & _possible(threshold))
    rows = rows.withColumns({"xs": F.when(F.col("open"), F.split("x", "")), "ys": F.when(F.col("open"), F.split("y", ""))})
    rows = rows.withColumn("ys", F.transform("ys", lambda c, j: F.struct(c.alias("c"), j.alias("j"))))
    band = (1 << (2 * threshold + 1)) - 1

    def step_(state: Column, item: Column) -> Column:
        match = None
        for k in range(2 * threshold + 1):
            at = item["j"] + (k - threshold)
            bit = F.when((at >= 0) & (at < F.col("n_x")) & (F.get(F.col("xs"), at) == item["c"]), F.lit(1 << k)).otherwise(F.lit(0))
            match = bit if match is None else match.bitwiseOR(bit)
        words = []
        for e in range(threshold + 1):
            w = state[f"r{e}"].bitwiseAND(match)
            if e:
                below = state[f"r{e - 1}"]
                w = w.bitwiseOR(below).bitwiseOR(F.shiftright(below, 1)).bitwiseOR(F.shiftleft(words[-1], 1)).bitwiseAND(F.lit(band))
            words.append(w)
        after = F.struct(*[w.alias(f"r{e}") for e, w in enumerate(words)])
        return F.when(state[f"r{threshold}"] == 0, state).otherwise(after)  # an empty band stays empty

    start = F.struct(*[F.lit(sum(1 << (threshold + i) for i in range(e + 1))).alias(f"r{e}") for e in range(threshold + 1)])
    last = F.aggregate("ys", start, step_, lambda s: s[f"r{threshold}"])
    end = F.col("n_x") - F.col("n_y") + threshold
    near = F.when(F.col("open"), F.call_function("shiftright", last, end).bitwiseAND(F.lit(1)) == 1)
    near = near.otherwise(F.greatest("n_x", "n_y") <= threshold)
    return rows.withColumn("near", near).drop("x", "y", "head", "tail", "open", "xs", "ys", "n_x", "n_y")


def _possible(threshold: int) -> Column:
    """Whether the cores x and y could be within threshold edits.

    Lines over 8192 characters longer in common may be trimmed in part, which only makes this test weaker. Where the cores
    differ in their first and last characters, one edit lies before the first matched character and one behind the last; so
    of the stretch of x between its first and last `threshold` characters, cut into threshold - 1 pieces, one is free
    of edits and stands in y, shifted by threshold at most.
    """
    trimmed = (F.left("x", F.lit(1)) != F.left("y", F.lit(1))) & (F.right("x", F.lit(1)) != F.right("y", F.lit(1)))
    if threshold < 2:
        return ~trimmed
    n = F.col("n_x") - 2 * threshold
    found = n < threshold - 1
    for k in range(threshold - 1):
        start, size = segment_bounds(n, k, threshold - 1)
        at = start + threshold + 1
        piece = F.substring(F.col("x"), at, size)
        for shift in range(-threshold, threshold + 1):
            found = found | (F.substring(F.col("y"), at + shift, size) == piece)
    return ~trimmed | found


def has_word(line: Column) -> Column:
    return line.rlike(f"[^{BLANKS}]")


def meet(probes: DataFrame, index: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a_id, b_id) of lines that share a key and whose letters allow for threshold edits."""
    more = ["more", "parts"] if "more" in probes.columns else []
    p, i = probes.select("id", "own", "key", *more).alias("p"), index.select("id", "key", *more).alias("i")
    # two own segments that meet would meet twice
    once = F.when(F.col("p.own"), F.col("p.id") < F.col("i.id")).otherwise(F.col("p.id") != F.col("i.id"))
    counts = [(F.col("p.id"), F.col("i.id"), len(LETTERS))] + [(F.col("p.more"), F.col("i.more"), len(MORE_LETTERS)) for _ in more[:1]]
    fits = once & counts_within(counts, threshold)
    if more:
        fits = fits & ~F.exists(F.zip_with("p.parts", "i.parts", lambda x, y: F.coalesce(x == y, F.lit(False))), lambda x: x)
    if more:  # rows are many times those that they come from, which sizes known before do not tell: neither side may be broadcast
        i = i.hint("merge")
    met = p.join(i, (F.col("p.key") == F.col("i.key")) & fits)
    return met.select(F.least("p.id", "i.id").alias("a_id"), F.greatest("p.id", "i.id").alias("b_id"))


def frequent_keys(own: DataFrame) -> tuple[DataFrame, bool]:
    """Keys that more than FREQUENT rows have, marked for broadcast where they are few, and whether there are any."""
    keys = cut(own.groupBy("key").count().where(F.col("count") > FREQUENT).select("key"))
    n = keys.count()
    return (F.broadcast(keys) if n <= BROADCAST_IDS else keys), n > 0


def texts_of(rows: DataFrame, wanted: DataFrame, key: str, value: Column | None = None) -> DataFrame:
    """h1, h2, line and, if rows have it, the first place of the distinct lines whose key, a column or value, is wanted.

    Very common lines are combined before they are dealt, whether the wanted keys are few enough to be broadcast or not.
    """
    aggregates = [F.first("line").alias("line")] + [F.min(c).alias(c) for c in rows.columns if c == "place"]
    wanted = cut(wanted)
    few = wanted.count() <= BROADCAST_IDS
    rows = rows if few else rows.groupBy("h1", "h2").agg(*aggregates)
    picked = (rows if value is None else rows.withColumn(key, value)).join(F.broadcast(wanted) if few else wanted, key, "left_semi")
    picked = picked.groupBy("h1", "h2").agg(*aggregates) if few else picked
    return picked.select("h1", "h2", *[c for c in ("line", "place") if c in picked.columns])


def candidates(lines: DataFrame, rows: DataFrame, threshold: int, least_chars: int) -> tuple[DataFrame, tuple[DataFrame, DataFrame] | None]:
    """Pairs (a_id, b_id) of lines within threshold edits, and some more: every line that is near an earlier one of its length has such
    a pair with one. What is left to look at for other lines comes as probes and index, whose keys may have very many rows."""
    probes = lines.select("h1", "h2", "id", "place", F.posexplode("keys").alias("n", "key")).where("key is not null").withColumn("own", F.col("n") <= threshold)
    own = lines.select("id", F.explode(F.slice("keys", 1, threshold + 1)).alias("key"))
    frequent, some = frequent_keys(own)
    if not some:
        return meet(probes, own, threshold), None
    pairs = meet(probes.join(frequent, "key", "left_anti"), own.join(frequent, "key", "left_anti"), threshold)
    hot = cut(probes.join(frequent, "key", "left_semi"))
    texts = texts_of(rows, hot.select("h1").distinct(), "h1")
    level = hot.join(texts, ["h1", "h2"]).select("id", "place", "own", letter_counts(F.col("line"), MORE_LETTERS).alias("more"), F.array().cast("array<bigint>").alias("parts"), F.col("key").alias("group"), without_segment(F.col("line"), F.col("n"), threshold, least_chars).alias("s"))
    left = None
    while True:
        level = cut(level)
        # own texts of a group have one length; where it is threshold at most, they are near each other
        short = level.where(F.col("own") & (F.char_length("s") <= threshold))
        centres = short.groupBy("group").agg(F.min_by("id", "place").alias("centre"))
        star = short.select("group", "id").join(centres, "group").where("id <> centre")
        pairs = pairs.unionByName(star.select(F.least("id", "centre").alias("a_id"), F.greatest("id", "centre").alias("b_id")))
        keyed = rest_keys(level, threshold)
        frequent, some = frequent_keys(keyed.where("own and not small"))
        joined = keyed.where("not small")
        joined = joined.join(frequent, "key", "left_anti") if some else joined
        pairs = pairs.unionByName(meet(joined, joined.where("own"), threshold))
        small = keyed.where("small")
        ends = small.where("not own"), small.where("own")
        left = ends if left is None else (left[0].unionByName(ends[0]), left[1].unionByName(ends[1]))
        if not some:
            return pairs, left
        level = keyed.where("not small").join(frequent, "key", "left_semi").select("id", "place", "more", "parts", "own", F.col("key").alias("group"), F.col("rest").alias("s")).distinct()


def first_lines(docs: DataFrame, id_col: str, text_col: str, threshold: int, least_chars: int, short_lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """The first occurrence of each distinct line (h1, h2, place), and those among them that repeat an earlier line with edits (h1, h2)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(docs).alias("row_key"), F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"))
    long = F.char_length("line") >= least_chars
    rows = rows.where(long | has_word(F.col("line")) if short_lines else long).withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line")})
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key", "line_no")
    # keys are made of short lines too, and not used: inside a condition their common parts would be computed again for each
    keyed = rows.select("h1", "h2", place.alias("place"), long.alias("long"), line_id(F.col("line"), F.col("h1")).alias("id"), segment_keys(F.col("line"), threshold, least_chars).alias("keys"))
    lines = cut(keyed.groupBy("h1", "h2").agg(F.min("place").alias("place"), F.first("long").alias("long"), F.first("id").alias("id"), F.first("keys").alias("keys")))
    firsts, rows, lines = lines.select("h1", "h2", "place"), rows.where(long), lines.where("long")
    pairs, left = candidates(lines, rows, threshold, least_chars)
    rows = rows.select("h1", "h2", "line", place.alias("place"))
    near = later_lines(pairs, rows, threshold)
    if left is None:
        return firsts, near
    # lines that are near an earlier one need no further pair, unless another line may be near them
    probes, index = left
    there = probes.select("id").union(index.select("id")).distinct()
    open_ = cut(lines.join(there, "id", "left_semi").join(near, ["h1", "h2"], "left_anti").select("id").distinct())
    open_ = F.broadcast(open_) if open_.count() <= BROADCAST_IDS else open_
    pairs = meet(probes.join(open_, "id", "left_semi"), index, threshold).unionByName(meet(probes.join(open_, "id", "left_anti"), index.join(open_, "id", "left_semi"), threshold))
    return firsts, cut(near.unionByName(later_lines(pairs, rows, threshold)).distinct())


def later_lines(pairs: DataFrame, rows: DataFrame, threshold: int) -> DataFrame:
    """h1, h2 of the later line of every pair (a_id, b_id) that is within threshold edits. rows: h1, h2, line, place."""
    pairs = cut(pairs.distinct())
    if pairs.isEmpty():
        return rows.select("h1", "h2").limit(0)
    # lines are chosen by the hash bits of their ids; letters are counted only for those
    bits = 4 * len(LETTERS)
    ids = pairs.select(F.col("a_id").alias("id")).union(pairs.select("b_id")).select(F.shiftright("id", bits).alias("hash")).distinct()
    texts = texts_of(rows, ids, "hash", F.shiftright("h1", bits))
    texts = texts.withColumn("id", line_id(F.col("line"), F.col("h1")))
    a = texts.select(F.col("id").alias("a_id"), F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("line").alias("a"), F.col("place").alias("a_place"))
    b = texts.select(F.col("id").alias("b_id"), F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("line").alias("b"), F.col("place").alias("b_place"))
    verified = within_edits(pairs.join(a, "a_id").join(b, "b_id"), "a", "b", threshold)
    later = F.when(F.col("a_place") > F.col("b_place"), F.struct(F.col("a1").alias("h1"), F.col("a2").alias("h2"))).otherwise(F.struct(F.col("b1").alias("h1"), F.col("b2").alias("h2")))
    # cut first: a filter pushed below these columns would hold each of them many times over
    return cut(verified.select("near", later.alias("later"))).where("near").select("later.*").distinct()


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, least_chars: int = LEAST_CHARS, report: bool = False, short_lines: bool = False) -> DataFrame:
    """docs with repeated lines taken out of the texts; all rows stay, in the columns they had.

    Lines are the \\n-split parts of a text, as they are. Their order is by id (nulls last), then row hash, then line
    number. A line of least_chars code points or more is taken out if an earlier one of that kind, kept or not, is
    equal or within `threshold` edits; shorter lines stay, or with short_lines
    those of them that are blank or equal to no earlier one. A text that loses all lines is empty, a null text
    stays null. Rows that are equal in all columns are one document and keep the same lines. report adds n_lines,
    n_kept, n_repeated (equal to an earlier line) and n_near (only near one) in front of a struct `row`.
    """
    key, kept, k_key, k_id, k_near = (free_name(docs, x) for x in ("row_key", "kept_lines", "k_key", "k_id", "k_near"))
    firsts, near = first_lines(docs, id_col, text_col, threshold, least_chars, short_lines)
    marked = firsts.join(near.withColumn("is_near", F.lit(True)), ["h1", "h2"], "left")
    by_doc = marked.groupBy(F.col("place.row_key").alias(k_key), F.col("place.doc_id").alias(k_id)).agg(
        F.collect_list(F.when(F.col("is_near").isNull(), F.col("place.line_no"))).alias(kept), F.count("is_near").alias(k_near)
    )
    keyed = docs.withColumn(key, row_key(docs))
    joined = keyed.join(by_doc, (F.col(key) == F.col(k_key)) & F.col(id_col).cast("long").eqNullSafe(F.col(k_id)), "left")
    lines = free_name(docs, "lines")
    joined = joined.withColumn(lines, F.split(text_col, "\n"))

    def untouched(i: Column) -> Column:
        line = F.get(F.col(lines), i)
        return (F.char_length(line) < least_chars) & ~has_word(line) if short_lines else F.char_length(line) < least_chars

    short = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), untouched)
    stay = free_name(docs, "stay")
    joined = joined.withColumn(stay, F.when(F.col(text_col).isNotNull(), F.sort_array(F.concat(short, F.coalesce(F.col(kept), F.array().cast("array<int>"))))))
    text = F.array_join(F.transform(stay, lambda i: F.get(F.col(lines), i)), "\n")
    if report:
        n = F.when(F.col(text_col).isNotNull(), F.size(lines)).otherwise(0).cast("long")
        n_kept = F.coalesce(F.size(stay), F.lit(0)).cast("long")
        n_kept = F.when(F.col(text_col).isNotNull(), n_kept).otherwise(F.lit(0).cast("long"))
        n_near = F.coalesce(F.col(k_near), F.lit(0)).cast("long")
        row = F.struct(*[(text if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns])
        return joined.select(n.alias("n_lines"), n_kept.alias("n_kept"), (n - n_kept - n_near).alias("n_repeated"), n_near.alias("n_near"), row.alias("row"))
    return joined.select(*[(text if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns])


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"), report=True, short_lines=True)
    return out.select("row.doc_id", "n_lines", "n_kept", "n_repeated", "n_near", F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("text_sha256"))
