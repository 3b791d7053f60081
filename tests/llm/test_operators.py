"""The operators on small tables, against plain Python, and on nulls, empty tables, repeats and clashing columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import components, exact_dedup, html_extract, line_dedup, mixing, quality, sentence_pieces, simhash, token_counts, token_files, warc
from keelson.llm.bytebpe import IdEncoder, default_path
from keelson.llm.common import fresh_dir
from keelson.llm.components import connected_components
from tests.llm import plain

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PAGE_SCHEMA = "page_id long, url string, html string"


def make_docs(seed=0, n=60):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randrange(2, 9))) for _ in range(80)]
    lines = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(5, 14))) for _ in range(40)]
    out = []
    for i in range(n):
        kind = rnd.randrange(6)
        if kind == 0:
            text = "\n".join(rnd.choice(lines) for _ in range(rnd.randrange(1, 9)))
        elif kind == 1:
            x = list(rnd.choice(lines))
            x[rnd.randrange(len(x))] = "Q"
            text = "\n".join([rnd.choice(lines), "".join(x), "short"])
        elif kind == 2:
            text = " ".join(f"{rnd.choice(vocabulary)}%%%" for _ in range(70))
        else:
            text = "\n".join(" ".join(rnd.choice(vocabulary) for _ in range(12)) + "." for _ in range(rnd.randrange(4, 9)))
        out.append((i, text, "xx", rnd.choice(["a", "a", "a", "b", "c", "Ω", None]), len(text)))
    out += [(n, None, None, None, None), (n + 1, "", None, "b", 0), (n + 2, out[3][1], "xx", "c", 1), (n + 3, out[3][1].upper(), "xx", "a", 1), (n + 4, " \n\t ", "xx", "a", 4), (n + 5, "word " * 6000, "xx", "a", 30000)]
    return out


DOCS = make_docs()
#: Nulls everywhere and repeated rows.
ROUGH = [(None, None, None, None, None), (None, "x y z", None, None, None), (7, "a b c", "l", "s", 5), (7, "a b c", "l", "s", 5), (7, "other text", "l", "s", 5), (8, "A B C", None, "s", None)]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


def clash(df, *names):
    return df.select("*", *[F.lit(1).alias(n) for n in names])


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


CLASHES = ("row_key", "size", "kept", "digest", "position", "copies", "lines", "h1", "grams", "w", "fp", "component", "key", "host", "payload", "n_tokens", "ids", "text_", "k_id", "stay", "kept_lines", "taken", "order", "range")

OPERATORS = {
    "sentencepiece": lambda d: sentence_pieces.encode_report(d),
    "encode": lambda d: sentence_pieces.encode_texts(d),
    "quality": lambda d: quality.quality(d, d.sparkSession.createDataFrame([(1, 1)], "doc_id long, quality int")),
    "keep_quality": lambda d: quality.keep_quality(d, d.sparkSession.createDataFrame([], "doc_id long, quality int")),
    "line_dedup": lambda d: line_dedup.line_dedup(d),
    "line_report": lambda d: line_dedup.line_dedup(d, report=True),
    "plan_mix": lambda d: mixing.plan_mix(d),
    "mix": lambda d: mixing.mix(d),
    "tokens": lambda d: token_files.read_token_index(d.sparkSession, r := fresh_dir(d.sparkSession, "t"), token_files.write_tokens(d, r)),
    "token_counts": lambda d: token_counts.token_counts(d),
    "exact_dedup": lambda d: exact_dedup.exact_dedup(d),
    "simhash": lambda d: simhash.simhash_groups(d),
    "near_dedup": lambda d: simhash.near_dedup(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_rough_and_clashing(spark, name):
    work = OPERATORS[name]
    per_row = name not in ("keep_quality", "mix", "near_dedup")
    assert work(spark.createDataFrame([], SCHEMA)).count() == 0
    rough = work(spark.createDataFrame(ROUGH, SCHEMA)).collect()
    again = work(spark.createDataFrame(ROUGH[::-1], SCHEMA)).collect()
    assert sorted(map(str, rough)) == sorted(map(str, again))
    if per_row:
        assert len(rough) == len(ROUGH)
    clashing = work(clash(spark.createDataFrame(ROUGH, SCHEMA), *CLASHES)).collect()
    # with other columns the rows have other keys, but the mix takes as many of each document
    assert len(clashing) == len(rough)


def test_exact_dedup(docs):
    lower = lambda t: (t or "").encode().lower()
    groups = {}
    for d, t, *_ in DOCS:
        groups.setdefault(lower(t), []).append(d)
    want = sorted(((d, max(g := groups[lower(t)]), len(g), d == max(g), hashlib.sha256(lower(t)).hexdigest()) for d, t, *_ in DOCS), key=str)
    for k in (2, 1024):  # few and many heavy hitters
        assert rows(exact_dedup.exact_dedup(docs, counters=k), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want


def test_mixing(docs):
    want = plain.mix_plan([(d, t, s) for d, t, _, s, _ in DOCS])
    for per_range in (1, 10, 10_000):
        got = mixing.plan_mix(docs, rows_per_range=per_range).withColumn("n", F.size("copies"))
        got = sorted(map(tuple, got.select("doc_id", "size", "source_size", "target", "taken", "n").collect()))
        assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in sorted(want)]
        assert np.allclose([g[3] for g in got], [w[3] for w in sorted(want)])
    sent = {}
    for (_, _, _, s, _), w in zip(DOCS, want, strict=True):
        sent.setdefault(s, [0, w[3]])[0] += w[4]
    assert all(abs(n - t) <= 0.5 for n, t in sent.values())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and sorted(r["doc_id"] for r in mixed.collect()) == sorted(w[0] for w in want for _ in range(w[5]))
    placed = mixing.mix(clash(docs, "position"), with_position=True)
    assert placed.columns == [*docs.columns, "position", "position_"]
    want_spots = sorted((r["doc_id"], x["position"]) for r in mixing.plan_mix(docs).collect() for x in r["copies"])
    assert [d for d, _ in want_spots] == sorted(r["doc_id"] for r in placed.collect()) and all(0 <= r["position_"] < 1 for r in placed.collect())
    spots = [x for r in mixing.plan_mix(docs).collect() for x in r["copies"]]
    assert all(0 <= x["position"] < 1 for x in spots)


def test_mixing_of_rows_without_ids(spark):
    """Rows without an id, and rows that share one, fall into many ranges."""
    docs = spark.createDataFrame([(None if i % 2 else 7, f"words of row {i}", "xx", "a", 1) for i in range(400)], SCHEMA)
    plan = mixing.plan_mix(docs, rows_per_range=10).collect()
    assert sum(r["taken"] for r in plan) == 1.5 * 1600 and len({x["position"] for r in plan for x in r["copies"]}) > 300


def test_mixing_of_equal_rows(spark):
    """Rows equal in all columns are laid block by block; each is taken as it would be one by one."""
    docs = spark.createDataFrame([(None, "the same three", "xx", "a", 1)] * 100 + [(None, "", "xx", "a", 1)] * 100 + [(1, "one", "xx", "b", 1)], SCHEMA)
    want = sorted((r["size"], r["taken"]) for r in mixing.plan_mix(docs).collect())
    for block in (1, 7, 100):
        got = mixing.plan_mix(docs, rows_per_block=block).collect()
        assert sorted((r["size"], r["taken"]) for r in got) == want and len(want) == 201
        assert sorted(r["nth"] for r in got if r["size"] == 3) == list(range(100))
        assert len({x["position"] for r in got if r["size"] == 3 for x in r["copies"]}) >= 100
    # a document that the quota cuts stays whole
    assert sum(w for _, w in want) == 452 and 150 <= mixing.mix(docs).where("source = 'a'").count() <= 151


def test_positions_invert_the_schedule(spark):
    q = spark.range(0, 1000).select((F.col("id") / 1000).alias("q"))
    for s in mixing.SCHEDULES:
        t = [r["t"] for r in q.select(mixing.position_of(F.col("q"), s).alias("t")).collect()]
        n = len(s)
        demand = [sum(w for w in s[: int(x * n)]) / sum(s) + (x * n - int(x * n)) * s[min(int(x * n), n - 1)] / sum(s) for x in t]
        assert np.allclose(demand, np.arange(1000) / 1000) and t == sorted(t)


def test_quality(spark, docs):
    labels = [(d, int("%%%" not in (t or ""))) for d, t, *_ in DOCS if d % 2]
    want = plain.quality_rows([(d, t) for d, t, *_ in DOCS], labels)
    got = {r["doc_id"]: r for r in quality.quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    for d, c, failed, score, kept in want:
        r = got[d]
        assert {k: r[k] for k in c} == c and r["base_failed"] == failed and r["kept"] == kept and abs(r["score"] - score) < 1e-9
    kept = quality.keep_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, *_, k in want if k)


@pytest.mark.parametrize(("threshold", "frequent"), [(1, 64), (2, 64), (1, 1), (2, 1)])
def test_line_dedup(docs, threshold, frequent, monkeypatch):
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(docs, threshold=threshold).collect()}
    assert [got[d] for d, *_ in DOCS] == plain.dedup_lines([(d, t) for d, t, *_ in DOCS], threshold)


@pytest.mark.parametrize(("threshold", "frequent"), [(1, 1), (2, 1), (2, 5)])
def test_lines_that_share_passages(spark, threshold, frequent, monkeypatch):
    """Lines that share most of their text are cut anew round by round; every line near an earlier one is found, in any order of lines."""
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)
    rnd = random.Random(threshold + frequent)
    texts = set()
    for _ in range(150):
        passage = rnd.choice(["the shared passage of some lines", "another one, short"])
        x = list(rnd.choice(["", "ab", "xyz "]) + passage + "".join(rnd.choice("ab") for _ in range(rnd.randrange(2, 6))) + rnd.choice(["", passage]))
        for _ in range(rnd.randrange(3)):
            i = rnd.randrange(len(x) + 1)
            x[i : i + rnd.randrange(2)] = rnd.choice(["", "é", "b"])
        texts.add("".join(x))
    texts = sorted(t for t in texts if len(t) >= 20)
    rnd.shuffle(texts)
    docs = list(enumerate(texts))
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(spark.createDataFrame(docs, "doc_id long, text string"), threshold=threshold).collect()}
    want = plain.dedup_lines(docs, threshold)
    assert [got[d] for d, _ in docs] == want and 20 < sum(t == "" for t in want) < len(want) - 5


@pytest.mark.parametrize("frequent", [4, 64])
def test_lines_with_a_counter(spark, monkeypatch, frequent):
    """Lines that differ in a number: pairs grow with the lines, not with their square, and the result is that of all pairs."""
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)
    made, later = [], line_dedup.later_lines
    monkeypatch.setattr(line_dedup, "later_lines", lambda pairs, rows, threshold: made.append(pairs.distinct().count()) or later(pairs, rows, threshold))
    rnd = random.Random(frequent)
    numbers = [*range(150), *range(1000, 1150)]
    rnd.shuffle(numbers)
    docs = [(i, f"Comment number {n} was posted by a reader of the page") for i, n in enumerate(numbers)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[d] for d, _ in docs] == plain.dedup_lines(docs, 2)
    if frequent == 4:  # 18,850 pairs are near
        assert sum(made) < 6000


def test_edit_distance(spark):
    rnd = random.Random(3)
    pairs = []
    for _ in range(200):
        a = "".join(rnd.choice("abé") for _ in range(rnd.randrange(30)))
        b = list(a)
        for _ in range(rnd.randrange(6)):
            i = rnd.randrange(len(b) + 1)
            b[i : i + rnd.randrange(2)] = rnd.choice(["", "a", "ß"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for t in (1, 2, 3):
        assert all(r["near"] == (plain.edits(r["a"], r["b"]) <= t) for r in line_dedup.within_edits(df, "a", "b", t).collect())


@pytest.mark.parametrize("group", [2, 2000])
def test_simhash(spark, docs, group, monkeypatch):
    """Small groups are dealt again and again; the links stay the same."""
    monkeypatch.setattr(simhash.fingerprint_links, "__defaults__", (group,))
    monkeypatch.setattr(components, "BROADCAST_ROWS", 0 if group == 2 else 200_000)
    want = [(d, *x) for (d, *_), x in zip(DOCS, plain.components([(d, t) for d, t, *_ in DOCS]), strict=True)]
    got = simhash.simhash_groups(docs).collect()
    assert sorted((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got) == sorted(want)
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in want})


def test_simhash_links_planted(spark):
    rnd = random.Random(9)
    values = set()
    for _ in range(10):
        y = rnd.getrandbits(64)
        for _ in range(30):
            values.add(y)
            y ^= 1 << rnd.randrange(64)
    signed = [plain.signed(v) for v in values]
    want = {(min(a, b), max(a, b)) for a in values for b in values if a != b and (a ^ b).bit_count() <= 3}
    for group in (3, 2000):
        edges = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"), group)
        got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
        root = {v: v for v in values}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in want:
            root[find(a)] = find(b)
        parts = {}
        for v in values:
            parts.setdefault(find(v), set()).add(got.get(plain.signed(v), plain.signed(v)))
        assert all(len(p) == 1 for p in parts.values()) and len(set().union(*parts.values())) == len(parts)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5000, 1001)], "u long, v long")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000, 5000: 1000}


@pytest.mark.parametrize("most", [0, 200_000])
def test_components_with_a_hub(spark, most, monkeypatch):
    """A star, a giant component and small ones: hot keys meet by broadcast, with the same result."""
    monkeypatch.setattr(components, "BROADCAST_ROWS", most)
    star = [(7, i) for i in range(100, 1500)] + [(i, i + 1) for i in range(5000, 5050)] + [(i + 1, i) for i in range(9000, 9100, 2)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(star, "u long, v long")).collect()}
    assert got == {7: 7} | {i: 7 for i in range(100, 1500)} | {i: 5000 for i in range(5000, 5051)} | {i: i - i % 2 for i in range(9000, 9100)}


def test_tokens(spark, docs):
    lib = IdEncoder(default_path()).lib
    start, want, counts = 0, [], []
    for d, t, *_ in DOCS:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        counts.append((d, len((t or "").encode()), len(ids) - 1, len(ids) - 1 > 512))
    root = fresh_dir(spark, "tokens")
    got = token_files.read_token_index(spark, root, token_files.write_tokens(docs, root))
    assert rows(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=str)
    assert rows(token_counts.token_counts(docs), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(counts, key=str)


def test_sentencepiece(spark, docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.default_path())
    ids = {d: sp.encode(t or "") for d, t, *_ in DOCS}
    got = sentence_pieces.encode_texts(docs)
    assert got.columns == [*docs.columns, "n_tokens", "ids"]
    assert {r["doc_id"]: (r["n_tokens"], r["ids"]) for r in got.collect()} == {d: (len(x), x) for d, x in ids.items()}
    both = sentence_pieces.decode_ids(got)
    assert both.columns == [*got.columns, "text_"] and both.where(F.coalesce("text", F.lit("")) != F.col("text_")).isEmpty()
    back = sentence_pieces.decode_ids(got.drop("text"))
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {d: t or "" for d, t, *_ in DOCS}
    report = {r["doc_id"]: r for r in sentence_pieces.encode_report(docs).collect()}
    assert all(r["round_trip"] and r["ids_crc32"] == zlib.crc32(np.array(ids[d], "<u4").tobytes()) for d, r in report.items())


PAGES = [(i, f"http://h{i % 3}.example/{i}", f"<body><nav>menu {i}</nav><article><h1>T {i}</h1><p>{'text ' * (10 * i)}{i % 7}</p></article></body>") for i in range(40)]
PAGES += [(100, "http://h0.example/x", PAGES[30][2]), (101, None, PAGES[30][2]), (102, "http://h1.example/n", None), (103, "bad url\n", ""), (None, "http://h1.example/z", PAGES[35][2]), (104, None, PAGES[2][2])]


def test_warc(spark):
    pages = clash(spark.createDataFrame(PAGES, PAGE_SCHEMA), "payload", "digest", "offset")
    root = fresh_dir(spark, "warc")
    assert warc.write_warc(pages, root, archive_bytes=2000).agg(F.sum("records")).first()[0] == len(PAGES)
    got = warc.read_warc(spark, f"{root}/part-*/*.warc.gz")
    assert got.where("gap is not null").count() == 0
    found = {r["page_id"]: r for r in got.select("*", warc.page_of("record_id").alias("page_id"), warc.page_of("refers_to").alias("first")).collect()}
    assert len(found) == len(PAGES)
    for p, _, h in PAGES:
        data = (h or "").encode()
        same = [q for q, _, x in PAGES if (x or "").encode() == data and q is not None]
        revisit = len(data) >= 1000 and len(same) > 0 and p != max(same)
        r = found[p]
        assert (r["record_type"], r["payload_bytes"], r["payload_digest"]) == ("revisit" if revisit else "response", len(data), hashlib.sha1(data).hexdigest())
        assert r["first"] == (max(same) if revisit else None) and (revisit or bytes(r["payload"]) == data)
    empty = warc.write_warc(spark.createDataFrame([], PAGE_SCHEMA), fresh_dir(spark, "w"))
    assert empty.count() == 0


def test_warc_quarantine(spark, tmp_path):
    good = [warc.member(warc.record_bytes(i, None, b"x" * 50, hashlib.sha1(b"x" * 50).hexdigest(), None, True)) for i in range(3)]
    bad = bytearray(good[1])
    bad[len(bad) // 2] ^= 0xFF
    (tmp_path / "a.warc.gz").write_bytes(good[0] + bytes(bad) + good[2])
    got = warc.read_warc(spark, str(tmp_path)).collect()
    gap = [r for r in got if r["gap"]]
    assert len(got) == 3 and (gap[0]["offset"], gap[0]["end"]) == (len(good[0]), len(good[0]) + len(bad)) and bytes(gap[0]["payload"]) == bytes(bad)


def test_warc_takes_long_records(spark, tmp_path, monkeypatch):
    """A url or page beyond what the salvage reader takes for a record is written and read back all the same."""
    monkeypatch.setattr(warc, "RECORD_BYTES", 1 << 16)
    pages = [(1, "http://a/" + "b" * 1_500_000, "short"), (2, "http://a/", "x" * 3_000_000), (3, "http://a/", "x" * 3_000_000), (4, None, None)]
    spark.createDataFrame(pages, PAGE_SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.op8_warc(spark, str(tmp_path)).collect())
    assert got == [(1, 5, "response", None), (2, 3_000_000, "revisit", 3), (3, 3_000_000, "response", None), (4, 0, "response", None)]


def test_warc_fails_on_lost_records(spark, tmp_path, monkeypatch):
    spark.createDataFrame(PAGES, PAGE_SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    assert warc.op8_warc(spark, str(tmp_path)).count() == len(PAGES)
    whole = warc.read_warc
    monkeypatch.setattr(warc, "read_warc", lambda *a, **k: whole(*a, **k).limit(3))
    with pytest.raises(ValueError, match="3 read"):
        warc.op8_warc(spark, str(tmp_path))


def test_html(spark):
    pages = clash(spark.createDataFrame(PAGES, PAGE_SCHEMA), "host", "wrapper", "text", "n_chars")
    got = {r["page_id"]: r for r in html_extract.extract_pages(pages).collect()}
    for p, u, h in PAGES:
        i = {100: 30, 101: 30, None: 35, 104: 2}.get(p, p)
        want = "" if not h else f"T {i}\n" + " ".join(["text"] * 10 * i + [str(i % 7)])
        assert got[p]["text"] == want and got[p]["n_chars"] == len(want) and got[p]["url"] == u
    assert html_extract.extract_pages(spark.createDataFrame([], PAGE_SCHEMA)).count() == 0


def test_html_without_classes(spark):
    """Pages of three hosts and many tasks whose furniture only the wrapper tells, by broadcast and by join."""
    from tests.llm.test_units import class_free

    rnd = random.Random(5)
    hosts = {h: [class_free(rnd, i, 2) for i in range(40)] for h in ("a.example", "b.example")} | {"c.example": [class_free(rnd, 0)]}
    data = [(100 * k + i, f"https://{h.upper()}:80/x{i}", p) for k, (h, ps) in enumerate(hosts.items()) for i, p in enumerate(ps)]
    want = {100 * k + i: t for k, (h, ps) in enumerate(hosts.items()) for i, t in enumerate(plain.main_texts(ps))}
    rnd.shuffle(data)
    pages = spark.createDataFrame(data, PAGE_SCHEMA).repartition(7)
    for chars in (1 << 20, 0):
        got = {r["page_id"]: r["text"] for r in html_extract.extract_pages(pages, names=False, broadcast_chars=chars).collect()}
        assert got == want and "Menu" not in "".join(t for i, t in got.items() if i < 200)


def test_html_with_many_template_texts(spark):
    """Furniture that rotates among 1,100 texts, and furniture whose 300 class names rotate: neither is forgotten."""
    rnd = random.Random(3)
    words = lambda i: " ".join(f"{rnd.choice('abcdefgh')}{i}x{k}" for k in range(12))
    name = lambda k: "q" + chr(97 + k % 26) + chr(97 + k // 26)
    data, want = [], {}
    for i in range(5500):
        t = words(i)
        page = f"<body><section><h1>{t}</h1><p>Text {i}</p></section><div>Advert {i % 1100}</div></body>"
        data.append((i, f"https://many.example/{i}", page))
        want[i] = f"{t}\nText {i}"
        if i < 1500:
            data.append((10_000 + i, f"https://names.example/{i}", page.replace(f"<div>Advert {i % 1100}", f"<div class={name(i % 300)}>Notice {i % 300}")))
            want[10_000 + i] = want[i]
    pages = spark.createDataFrame(data, PAGE_SCHEMA).repartition(5)
    assert {r["page_id"]: r["text"] for r in html_extract.extract_pages(pages, names=False).collect()} == want


def test_pipeline(spark, tmp_path):
    import sentencepiece

    import corpus_pipeline

    labels = [(d, int("%%%" not in (t or ""))) for d, t, *_ in DOCS if d % 2]
    spark.createDataFrame(DOCS, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted(((r["doc_id"], r["text"], r["n_chars"], r["ids"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()))
    kept = {d for d, *_, k in plain.quality_rows([(d, t) for d, t, *_ in DOCS], labels) if k}
    docs = [(d, t, s) for d, t, _, s, _ in DOCS if d in kept]
    docs = [(d, t, s) for (d, _, s), t in zip(docs, plain.dedup_lines([(d, t) for d, t, _ in docs]), strict=True)]
    stay = {c for _, c in plain.components([(d, t) for d, t, _ in docs])}
    docs = [x for x in docs if x[0] in stay]
    sp = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.default_path())
    want = sorted((d, t, len(t), sp.encode(t)) for (d, t, _), w in zip(docs, plain.mix_plan(docs), strict=True) for _ in range(w[5]))
    assert got == want and len(want) > 5
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5


def test_near_dedup_of_changed_words(spark):
    """Copies with some words changed have similarity 0.8 or more and differ in more than three fingerprint bits; less similar texts stay."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    texts = []
    for k in range(30):
        base = [word() for _ in range(200)]
        texts.append(base)
        for n in (2, 3, 14):
            x = list(base)
            for j in range(n):
                x[20 + j * 12] = word()
            texts.append(x)
    sets = [{tuple(t[i : i + 5]) for i in range(196)} for t in texts]
    assert all(len(sets[i] & sets[i + n]) / len(sets[i] | sets[i + n]) >= 0.8 for i in range(0, 120, 4) for n in (1, 2))
    prints = simhash.fingerprints([" ".join(t).encode() for t in texts], len(texts)).tolist()
    assert sum((prints[i] ^ prints[i + 2]).bit_count() > 3 for i in range(0, 120, 4)) > 10
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.near_dedup(docs).collect()) == [i for i in range(120) if i % 4 in (0, 3)]


@pytest.mark.parametrize("table", ["empty", "rough"])
def test_stages_on_odd_tables(spark, tmp_path, table):
    """Every stage takes an empty table and one of nulls and repeats, both with clashing names; all but the last keep the columns."""
    import corpus_pipeline

    spark.createDataFrame([(7, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = clash(spark.createDataFrame(ROUGH if table == "rough" else [], SCHEMA), *CLASHES, "node", "root", "shingles", "tile", "keys")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        n = len(out.collect())
        assert name == "sentencepiece" or out.columns == docs.columns
        assert n == {"quality_rules": 0, "near_dedup": 4 if table == "rough" else 0}.get(name, n) and (table == "rough" or n == 0)


def test_short_lines_that_repeat(spark, tmp_path):
    """op4 and the pipeline take out equal lines of any length; blank lines stay and short ones are not compared by edits."""
    import corpus_pipeline

    texts = ["Les.\n\na line that is long enough\nLes.", "Les.\nLes!\n \n\nAnd ornd.", "a line that is long enough.\nAnd ornd.\nnew", None, ""]
    want = ["Les.\n\na line that is long enough", "Les!\n \n\nAnd ornd.", "new", None, ""]
    docs = spark.createDataFrame([(i, t, "xx", "a", len(t or "")) for i, t in enumerate(texts)], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = line_dedup.op4_line_dedup(spark, str(tmp_path)).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    counts = [(4, 3, 1, 0), (5, 4, 1, 0), (3, 1, 1, 1), (0, 0, 0, 0), (1, 1, 0, 0)]
    assert sorted(map(tuple, got)) == [(i, *c, sha(t)) for i, (c, t) in enumerate(zip(counts, want, strict=True))]
    piped = corpus_pipeline.drop_repeated_lines(spark, docs, str(tmp_path)).collect()
    assert [r["text"] for r in sorted(piped, key=lambda r: r["doc_id"])] == want


def test_very_long_text(spark):
    """A text of a million characters, in many lines and in one word, beside short ones."""
    rnd = random.Random(2)
    lines = [" ".join(f"w{rnd.randrange(5000)}" for _ in range(12)) for _ in range(15_000)]
    long = "\n".join(lines)
    docs = spark.createDataFrame([(1, long, "xx", "a", len(long)), (2, "x" * 500_000, "xx", "a", 500_000), (3, lines[7] + "\nother words here", "xx", "a", 9)], SCHEMA)
    assert {r["doc_id"]: r["n_words"] for r in quality.quality(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).collect()} == {1: 180_000, 2: 1, 3: 15}
    assert line_dedup.line_dedup(docs.where("doc_id <> 2")).where("doc_id = 3").first()["text"] == "other words here"
    lib = IdEncoder(default_path()).lib
    want = {d: len(lib.encode(t, add_special_tokens=False).ids) for d, t in ((1, long), (3, lines[7] + "\nother words here"))}
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs.where("doc_id <> 2")).collect()} == want
    assert simhash.simhash_groups(docs).count() == simhash.near_dedup(docs).count() == exact_dedup.exact_dedup(docs).where("kept").count() == 3
    assert {r["doc_id"]: r["taken"] > 0 for r in mixing.plan_mix(docs).collect()}[1]
