"""The operators' parts against plain Python."""

import base64
import hashlib
import io
import random
import subprocess
import sys
import time
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keelson.llm import bytebpe, pfor, pieces, shingles, warc, wrappers
from keelson.llm.exact_dedup import misra_gries
from keelson.llm.html_extract import aside, extract, is_furniture_name
from keelson.llm.dom import parse
from keelson.llm.simhash import fingerprints, stars, trie_links
from keelson.llm.token_files import read_shard, shard_bytes
from tests.llm import plain

ODD = ["", "a  b", "a \n b", "a\n", "a ", " a", "x <|endoftext|> y<|endoftext|>", "\n\n a\n\n\nb   c \t d", "it's I'll 12 345  !!", "\x1c\x1d a\x1fb \x85 c d  e", "日本語 テキスト 😀😀", "''s '' s", " ​ x　y", "\t", "ﬁ ²³ ٣٤", "\n", "x" * 3000, " " * 50 + "a", "a\u0000b", "▁x ▁ y"]
ALPHABET = "abcdeéABC 12.,;:\n日本語的是한국αβ😀▁\t'\"-"
TEXT = st.text(alphabet=ALPHABET, max_size=60)


@pytest.fixture(scope="module")
def byte_models():
    path = bytebpe.default_path()
    return bytebpe.IdEncoder(path), bytebpe.token_counter(path)


def check_bytes(models, text):
    encoder, counter = models
    want = encoder.lib.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == want and counter.count(text) == len(want)


@pytest.mark.parametrize("text", ODD)
def test_byte_bpe_odd_texts(byte_models, text):
    check_bytes(byte_models, text)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_byte_bpe(byte_models, text):
    check_bytes(byte_models, text)


def test_other_vocabularies_are_refused():
    import public_tokenizers

    for use in (bytebpe.TokenCounter, bytebpe.IdEncoder):
        with pytest.raises(ValueError, match="byte-level"):
            use(public_tokenizers.path("word_bpe_49k.json"))


def test_pieces_without_opening_tokens_fall_back():
    """A vocabulary in which pieces can't be told by their first tokens costs speed, not results."""
    encoder = bytebpe.IdEncoder(bytebpe.default_path())
    encoder.opens[:] = False
    for text in ("two words", "one\ntwo three", "", "word"):
        assert encoder.encode([text]) == [encoder.plain(text)]


def test_every_kind_of_character(byte_models):
    """White space, letters and numbers are told apart as the library does, over all of the first plane."""
    encoder, counter = byte_models
    for start in range(0, 0xD800, 0x400):
        text = "".join(f"a{chr(c)}1{chr(c)}{chr(c)} " for c in range(start, start + 0x400))
        assert counter.count_plain(text) == len(encoder.lib.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def piece_model():
    return pieces.PieceModel(pieces.default_path())


@pytest.mark.parametrize("text", ODD)
def test_pieces_odd_texts(piece_model, text):
    want = piece_model.sp.encode(text)
    got = piece_model.encode([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == want and piece_model.decode(got) == piece_model.sp.decode(want)


@settings(max_examples=500, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_pieces(piece_model, texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in piece_model.encode(texts)] == [piece_model.sp.encode(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60_000), st.integers(0, 2**32 - 1)), max_size=700), st.integers(0, 6), st.integers(0, 6))
def test_pfor(values, first, last):
    x = np.array(values, np.uint32)
    data = pfor.encode(x)
    assert (pfor.decode(data) == x).all()
    assert (pfor.decode(data, first, last) == x[first * pfor.BLOCK : max(first, last) * pfor.BLOCK]).all()


def test_shard():
    ids = [np.arange(n, dtype="<u4").tobytes() for n in (1, 300, 2)]
    keys, ends, before, back = read_shard(shard_bytes([5, None, 7], ids, 11))
    assert keys == [5, None, 7] and ends.tolist() == [1, 301, 303] and before == 11 and back.astype("<u4").tobytes() == b"".join(ids)
    with pytest.raises(ValueError):
        read_shard(b"nope" + bytes(30))


@given(st.lists(st.integers(0, 12), max_size=300), st.integers(1, 6))
def test_misra_gries_keeps_the_frequent(keys, k):
    counts = {}
    for x in keys:
        misra_gries(counts, x, k)
    assert len(counts) <= k
    for x in set(keys):
        n = keys.count(x)
        assert n - len(keys) / (k + 1) <= counts.get(x, 0) <= n


def near_values(rnd, n=60):
    out = set()
    for _ in range(8):
        base = rnd.getrandbits(64)
        for _ in range(n // 8):
            y = base
            for _ in range(rnd.randrange(6)):
                y ^= 1 << rnd.randrange(64)
            out.add(y)
    return sorted(out)


@pytest.mark.parametrize("most", [1, 7, 1 << 18])
@pytest.mark.parametrize("seed", range(5))
def test_trie_links(seed, most):
    v = near_values(random.Random(seed))
    groups = np.array([0] * len(v) + [1] * len(v))
    values = np.array(v + v, np.uint64)
    i, j = (np.concatenate(x) for x in zip(*trie_links(groups, values, most=most), strict=True))
    got = {(min(p), max(p)) for p in zip(i.tolist(), j.tolist(), strict=True)}
    want = {(g + a, g + b) for g in (0, len(v)) for a in range(len(v)) for b in range(a + 1, len(v)) if (v[a] ^ v[b]).bit_count() <= 3}
    assert got == want and len(i) == len(want)
    root = stars(len(values), trie_links(groups, values, most=most))
    for a, b in want:
        assert root[a] == root[b]


def test_fingerprints(monkeypatch):
    import xxhash

    def plain(t):
        w = t.lower().split()
        sh = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
        hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    texts = [b"", b" \n\t", b"One", b"one two", "É one\x0btwo three\x0cfour é".encode(), b"a b c a b c a b c", "a b c d e".encode()]
    assert fingerprints(texts, len(texts)).tolist() == [plain(t) for t in texts]
    monkeypatch.setattr(shingles, "SLICE", 5)
    assert fingerprints(texts, len(texts)).tolist() == [plain(t) for t in texts]


LONG_TEXT = r"""
import resource, sys
from keelson.llm import minhash, simhash
text = b"".join(b"Word%d of a%d text\n" % (i % 90001, i % 1013) for i in range(2_500_000))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
simhash.fingerprints([text], 1)
print(len(text) >> 20, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
"""


def test_fingerprint_of_a_long_text():
    """A text of 50 MB costs less than 300 MB."""
    size, used = map(int, subprocess.run([sys.executable, "-c", LONG_TEXT], capture_output=True, text=True, cwd=Path(__file__).parents[2], check=True).stdout.split())
    assert size >= 45 and used < 300


def test_extract():
    page = """<html><body class="no-sidebar"><header><a href=/>Site</a></header><div id="cookie-notice">We use cookies</div><main><article class="post"><header><h1>Title &amp; more</h1></header>
      <p>Hello <b>bold</b>&nbsp;x<p>Second<br>line<div class="share">Share me</div><form>Your mail<input></form><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table><aside>side</aside><!-- c -->
      <section id="comments"><p>Nice post</p></section></article></main><aside>Side</aside><footer>F</footer><script>var x = "<p>no</p>"</script></body>"""
    assert extract(page) == "Title & more\nHello bold x\nSecond line\none\ntwo\na b\nc"
    assert extract(None) == extract("") == extract("<script>x") == "" and extract("<div>" * 5000 + "deep") == "deep" and extract("a<b & c") == "a<b & c"
    assert extract("<div class=content><div>one</div><div>two</div></div><div class=sidebar>s</div>") == "one\ntwo"


def tree_of(source):
    return wrappers.page_tree(parse(source, is_furniture_name)).without_nodes()


def wrapper_of(sources):
    """The compiled wrapper of some pages, through the forms in which it travels."""
    halves = [None, None]
    for k, x in enumerate(sources):
        t = tree_of(x)
        halves[k % 2] = t if halves[k % 2] is None else wrappers.merge(halves[k % 2], t)
    whole = [wrappers.loads(wrappers.dumps(h)) for h in halves if h is not None]
    return wrappers.load_compiled(wrappers.compiled(whole[0] if len(whole) < 2 else wrappers.merge(*whole), aside))


def test_wrapper_finds_template():
    pages = [f"<body><article><h1>Title {i}</h1><p>Text {i}.</p><p>More {i * i}.</p><div class=x>Read our other stories</div></article></body>" for i in range(6)]
    # root, body, article, h1, one slot for both paragraphs, div
    assert wrappers.matching(tree_of(pages[0]), tree_of(pages[1])) == 6
    assert extract(pages[2], wrapper_of(pages)) == "Title 2\nText 2.\nMore 4.\nRead our other stories"  # the largest text of each page
    pages = [p.replace(f"Title {i}", f"A{i} longer{i} title{i} of{i} page {i}") for i, p in enumerate(pages)]
    assert extract(pages[2], wrapper_of(pages)) == "A2 longer2 title2 of2 page 2\nText 2.\nMore 4."
    assert extract(pages[2]).endswith("other stories")
    assert extract(pages[0], wrapper_of(pages[:1] * 6)) == extract(pages[0])  # one article on all pages has no template


def records(n=6):
    out = []
    for i in range(n):
        p = f"<p>page {i}</p>".encode() * 50
        out.append(warc.record_bytes(i, f"http://x/{i}", p, hashlib.sha1(p).hexdigest(), None, True))
    return out


def salvaged(data, **options):
    found = list(warc.salvage(io.BytesIO(data), **options))
    return [x for x in found if isinstance(x, warc.Record)], [x for x in found if isinstance(x, warc.Gap)]


@pytest.mark.parametrize("piece", [64, 1 << 18])
def test_salvage(piece, monkeypatch):
    monkeypatch.setattr(warc, "PIECE", piece)
    rs = records()
    ms = [warc.member(r) for r in rs]
    at = np.cumsum([0, *map(len, ms)]).tolist()
    data = b"".join(ms)
    found, gaps = salvaged(data)
    assert len(found) == 6 and not gaps and found[2].payload == b"<p>page 2</p>" * 50
    bad = bytearray(data)
    bad[at[2] + 40] ^= 0xFF
    found, gaps = salvaged(bytes(bad))
    assert len(found) == 5 and [(g.offset, g.end) for g in gaps] == [(at[2], at[3])]
    found, gaps = salvaged(data[: at[5] + 30])
    assert [(g.offset, g.end) for g in gaps] == [(at[5], at[5] + 30)]
    junk = b"garbage\x1f\x8b\x08junk"
    found, gaps = salvaged(data[: at[1]] + junk + data[at[1] :])
    assert len(found) == 6 and [(g.offset, g.end) for g in gaps] == [(at[1], at[1] + len(junk))]
    plain = b"".join(rs)
    assert len(salvaged(plain)[0]) == len(salvaged(warc.member(plain))[0]) == 6
    hurt = plain.replace(b"page 3", b"pagf 3", 1)
    ends = np.cumsum([0, *map(len, rs)]).tolist()
    found, gaps = salvaged(hurt)
    assert len(found) == 5 and [(g.offset, g.end, g.inner) for g in gaps] == [(ends[3], ends[4], None)]
    one = warc.member(hurt)
    found, gaps = salvaged(one)  # sound as a member: the gap is the record's own range in it
    assert len(found) == 5 and [(g.offset, g.end, g.inner, g.inner_end) for g in gaps] == [(0, len(one), ends[3], ends[4])]
    assert salvaged(b"") == ([], []) and salvaged(b"nothing here")[1] == [warc.Gap(0, 12, "no version line")]


def test_salvage_of_a_damaged_whole_file():
    """Sound records in front of the damage are recovered, and all of them if only the last check fails."""
    rs = [r + b"" for r in records(40)]
    z = warc.member(b"".join(rs))
    wrong = bytearray(z)
    wrong[-8] ^= 1  # the CRC
    found, gaps = salvaged(bytes(wrong))
    assert len(found) == 40 and [(g.offset, g.end) for g in gaps] == [(0, len(z))]
    found, gaps = salvaged(z[: len(z) // 2])
    assert 5 < len(found) < 40 and len(gaps) == 1


def test_digests_of_all_forms():
    p = b"some page"
    digest = hashlib.sha1(p).hexdigest()
    r = warc.record_bytes(1, None, p, digest, None, True)
    b32 = base64.b32encode(bytes.fromhex(digest))
    for form in (b32, b32.lower(), digest.encode(), digest.upper().encode()):
        found, gaps = salvaged(r.replace(b32, form))
        assert len(found) == 1 and not gaps and warc.sha1_hex(found[0].fields["warc-payload-digest"]) == digest
    for form in (b"!!!", b"", b"ABC", b32[:-1] + b"1"):
        assert len(salvaged(r.replace(b32, form))[0]) == 1  # nothing that could be checked
    assert len(salvaged(r.replace(b"sha1:", b"md5:"))[0]) == 1
    assert len(salvaged(r.replace(b"some page", b"same page"))[1]) == 1
    revisit = warc.record_bytes(2, None, p, digest, 1, False)
    assert len(salvaged(revisit.replace(b32, b32.lower()))[0]) == 1 and len(salvaged(revisit.replace(b32, digest.encode()))[0]) == 1


def test_salvage_holds_one_record():
    """An archive of 200 MB in one member is streamed."""
    p = b"<p>page</p>" * 100_000
    r = warc.record_bytes(1, None, p, hashlib.sha1(p).hexdigest(), None, True)
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    data = io.BytesIO(b"".join([*(z.compress(r) for _ in range(200)), z.flush()]))
    tracemalloc.start()
    n = sum(isinstance(x, warc.Record) for x in warc.salvage(data))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 200 and peak < 20 << 20
    assert [type(x) for x in warc.salvage(io.BytesIO(r), most=1000)] == [warc.Gap]


def test_copies_keep_their_list():
    """Copies of one page agree on a list that no other page has; it is content."""
    others = [f"<body><article><h1>The{i} story{i} number{i}, and more</h1><p>Text {i}.</p><div class=x>Read our other stories</div></article></body>" for i in range(20)]
    copied = "<body><nav>Menu {}</nav><article><h1>Own title of the copied story</h1><p>Words</p><ul><li>one<li>two</ul><blockquote>Said</blockquote><div class=x>Read our other stories</div></article></body>"
    wrapper = wrapper_of([*others[:9], *[copied.format(k) for k in range(5)], *others[9:]])
    assert extract(copied.format(2), wrapper) == "Own title of the copied story\nWords\none\ntwo\nSaid"
    assert extract(others[3], wrapper) == "The3 story3 number3, and more\nText 3."
    few = [f"<body><article><h1>T {i}</h1><p>{i}.</p><h2>Rare</h2></article></body>" for i in range(4)]
    assert extract(few[1], wrapper_of([*others * 25, *few])) == "T 1\n1.\nRare"  # 4 pages of 504


def test_deep_pages():
    """Surplus levels neither close what is above them nor hide furniture, blocks or template below."""
    deep = "<div>" * 200
    page = f"<div><article><p>first</p>{deep}{'</div>' * 200}<p>rest</p></article></div>"
    assert extract(page) == "first\nrest"
    page = f"<article>{deep}<p>one<p>two<nav>menu</nav><div class=share>Share</div><ul><li>a<li>b</ul><footer>foot</footer>{'</div>' * 200}<p>rest</p></article><footer>F</footer>"
    assert extract(page) == "one\ntwo\na\nb\nrest"
    assert extract(f"{'<div>' * 3000}<article><p>in</p></article>out") == "in"
    pages = [f"<body><article><h1>Long{i} title{i} of{i} page{i}</h1>{'<div>' * 3000}<p>Text {i}.</p><div class=x>Read more</div></article></body>" for i in range(6)]
    assert extract(pages[2], wrapper_of(pages)) == "Long2 title2 of2 page2\nText 2."


def test_wide_pages():
    """Pages of 20,000 elements in alternation are matched in time: a slot stands for all of one kind."""
    row = lambda i, k: f"<h2>Head {i} {k}</h2><p>Text{i} {k}a{i} with some words{i}</p><div class=b>Box {k % 3}</div>"
    pages = ["<body><main>" + "".join(row(i, k) for k in range(7000)) + "</main></body>" for i in range(5)]
    began = time.time()
    wrapper = wrapper_of(pages)
    got = extract(pages[3], wrapper)
    assert time.time() - began < 60 and sum(1 for _ in wrapper.walk()) < 12
    assert got == "\n".join(x for k in range(7000) for x in (f"Head 3 {k}", f"Text3 {k}a3 with some words3"))
    odd = lambda i: "<body>" + "".join(f"<div class='c{chr(97 + (k * i) % 26)}{chr(97 + k % 26)}x'><p>{i} {k}</p></div>" for k in range(3000)) + "</body>"
    began = time.time()
    wrapper = wrapper_of([odd(i) for i in range(1, 9)])
    assert time.time() - began < 60 and len(wrapper.kids[0].kids) <= wrappers.WIDEST


def class_free(rnd, i, ads=3):
    """A page without classes: menu and footer rotate among a few texts, a notice stands in the article, comments do not."""
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    menu = "".join(f"<li>Menu {rnd.randrange(5)}</li>" for _ in range(3))
    text = "".join(f"<p>{' '.join(word() for _ in range(rnd.randrange(3, 20)))}</p>" for _ in range(rnd.randrange(1, 6)))
    shown = f"<div>Advert {rnd.randrange(ads)}</div>" if rnd.random() < 0.8 else ""
    return f"<body><div><ul>{menu}</ul></div><section><h1>{word()} {i}</h1>{text}<div>Support our work, variant {rnd.randrange(2)}</div></section>{shown}<div><b>Imprint {i % 4}</b></div></body>"


@pytest.mark.parametrize("seed", range(4))
def test_class_free_pages(seed):
    """Furniture that rotates is found by the wrapper alone, as a plain implementation over index paths finds it."""
    rnd = random.Random(seed)
    pages = [class_free(rnd, i) for i in range(60)]
    wrapper, want = wrapper_of(pages), plain.main_texts(pages)
    got = [extract(p, wrapper, names=False) for p in pages]
    assert got == want
    assert not any(w in t for t in got for w in ("Menu", "Advert", "Imprint", "Support")) and all("Menu" in extract(p) for p in pages)


def test_vague_names():
    """A class like widget or tags is furniture where nothing else is known, and content where the host's pages say so."""
    pages = [f"<body><div class=content><h1>A{i} title{i} that{i} is{i} long{i} enough</h1><div class=widget>Words of page {i}</div><div class=tags>One of {i % 2}</div><div class=comments>said {i}</div></div></body>" for i in range(30)]
    assert extract(pages[5]) == "A5 title5 that5 is5 long5 enough"
    assert extract(pages[5], wrapper_of(pages)) == "A5 title5 that5 is5 long5 enough\nWords of page 5"
