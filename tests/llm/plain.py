"""The operators in plain Python, for tables that fit in memory."""

import collections
import hashlib
import math
import re
import struct

import xxhash

from keelson.llm import line_dedup, mixing, quality
from keelson.llm.simhash import fingerprints

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def base_counts(t):
    t = t or ""
    w = words(t)
    n = len(w)
    count = collections.Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    covered = {j for i in range(n - 2) if count[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return {"n_words": n, "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def grams(t):
    import regex

    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in regex.findall(r"[\p{L}\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]+", t or "")]
    pair = lambda a, b: xxhash.xxh64_intdigest(struct.pack("<Q", b), xxhash.xxh64_intdigest(struct.pack("<Q", a), 42))
    return [x % quality.BUCKETS for x in h] + [pair(a, b) % quality.BUCKETS for a, b in zip(h, h[1:], strict=False)]


def quality_rows(docs, labels):
    """doc_id to (base counts, base_failed, score, kept); docs: (doc_id, text)."""
    good = {d for d, q in labels if q == 1}
    raw, mine = collections.Counter(), collections.Counter()
    features = [grams(t) for _, t in docs]
    for (d, _), g in zip(docs, features, strict=True):
        raw.update(g)
        if d in good:
            mine.update(g)
    n, m = sum(raw.values()) + quality.BUCKETS, sum(mine.values()) + quality.BUCKETS
    weight = lambda b: round(1e6 * (math.log((mine[b] + 1) / m) - math.log((raw[b] + 1) / n))) if mine else 0
    out = []
    for (d, t), g in zip(docs, features, strict=True):
        c = base_counts(t)
        failed = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
        score = sum(map(weight, g)) / len(g) / 1e6 if g else 0.0
        out.append((d, c, failed, score, not failed and score >= quality.THRESHOLD))
    return out


def edits(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def dedup_lines(docs, threshold=line_dedup.THRESHOLD, least=line_dedup.LEAST_CHARS):
    """Texts by position; docs: (doc_id, text), ids in order and unique."""
    exact, by_size, out = set(), collections.defaultdict(list), []
    for _, t in docs:
        if t is None:
            out.append(None)
            continue
        kept = []
        for x in t.split("\n"):
            if len(x) < least:
                kept.append(x)
                continue
            if x not in exact and not any(edits(x, y) <= threshold for k in range(len(x) - threshold, len(x) + threshold + 1) for y in by_size[k]):
                kept.append(x)
            if x not in exact:
                exact.add(x)
                by_size[len(x)].append(x)
        out.append("\n".join(kept))
    return out


def components(docs):
    """(fingerprint, component_id) by position."""
    fp = [int(x) for x in fingerprints([(t or "").encode() for _, t in docs], len(docs))]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 3:
                root[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [(fp[i], low.get(find(i))) for i in range(len(docs))]


def mix_plan(docs):
    """(doc_id, size, source_size, target, taken, copies) per document; docs: (doc_id, text, source)."""
    size = [len(words(t)) for _, t, _ in docs]
    by = collections.defaultdict(list)
    for i, (_, _, s) in enumerate(docs):
        by[s].append(i)
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + ([None] if None in by else [])
    total = {s: sum(size[i] for i in by[s]) for s in names}
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    left, target = 1.5 * sum(size), {}
    free = set(names)
    while free:  # stop those that are above, share the rest anew
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if unit * weight[s] > 2 * total[s]}
        if not full:
            target |= {s: unit * weight[s] for s in free}
            break
        target |= {s: 2.0 * total[s] for s in full}
        left -= sum(target[s] for s in full)
        free -= full
    out = [None] * len(docs)
    for s in names:
        order = sorted(by[s], key=lambda i: (hashlib.md5(f"mix:{'null' if docs[i][0] is None else docs[i][0]}:{hashlib.md5((docs[i][1] or '').encode()).hexdigest()}".encode()).hexdigest(), docs[i][0] or 0, size[i]))
        at, quota = 0, math.floor(target[s] + 0.5)
        for i in order:
            takes = [max(0, min(size[i], quota - at - c * total[s])) for c in (0, 1)]
            out[i] = (docs[i][0], size[i], total[s], target[s], sum(takes), sum(t > 0 for t in takes))
            at += size[i]
    return out


def main_texts(pages):
    """Main texts of well-formed pages of one host without class names, by index paths and full counts.

    A text's place is its path; rows of p and li share one. A place is template if nine in ten of its texts stand on pages
    of four different contents or more. The deepest element without content beside it is the article.
    """
    import xml.etree.ElementTree as ET

    def leaves(node, path, out):
        text = " ".join("".join(x for x in [node.text, *(c.text if c.tag == "b" else None for c in node), *(c.tail for c in node)] if x).split())
        if text:
            out.append((path, text))
        seen = collections.Counter()
        for c in node:
            if c.tag != "b":
                leaves(c, (*path, c.tag if c.tag in ("p", "li") else f"{c.tag}{c.get('k', seen[c.tag])}"), out)
                seen[c.tag] += 1

    parsed, content = [], []
    for p in pages:
        out = []
        # the advert may be missing: the imprint, told by its <b>, keeps its own place
        leaves(ET.fromstring(p.replace("<div><b>", '<div k="last"><b>')), ("body",), out)
        parsed.append(out)
        w = max(out, key=lambda x: len(x[1]))[1].split()
        content.append(min(xxhash.xxh32_intdigest(" ".join(w[i : i + 3])) for i in range(max(1, len(w) - 2))))
    beside, count = collections.defaultdict(set), collections.Counter()
    for out, c in zip(parsed, content, strict=True):
        for x in out:
            beside[x].add(c)
            count[x] += 1
    total, repeated = collections.Counter(), collections.Counter()
    for (path, text), n in count.items():
        total[path] += n
        repeated[path] += n * (len(beside[path, text]) >= 4)
    fixed = {p for p in total if repeated[p] >= 0.9 * total[p]}
    inside = [p for p in total if p not in fixed]
    k = min(map(len, inside)) - 1
    while len({p[:k] for p in inside}) > 1:
        k -= 1
    main = inside[0][:k]
    return ["\n".join(t for p, t in out if p not in fixed and p[: len(main)] == main) for out in parsed]
