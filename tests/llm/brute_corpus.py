"""Plain-Python versions of the corpus operators, for small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import string
from collections import Counter, defaultdict
from itertools import combinations

import public_tokenizers
import tiktoken
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def rule_row(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def rule_statistics(text):
    """Symbols, repeated lines, words in repeated windows, capitals, digits, punctuation, word length: each over its base."""
    n, chars, symbols, dup, repeated, _ = rule_row(text)
    text = text or ""
    lines = sum(bool(WORD.search(line)) for line in text.split("\n"))
    n, chars, lines = max(n, 1), max(chars, 1), max(lines, 1)
    punctuation = len(re.findall(r"[!?;:()\[\]{}\"'/\\_=+\-~^@`]", text))
    return (
        symbols / n, dup / lines, repeated / n, len(re.findall("[A-Z]", text)) / chars, len(re.findall("[0-9]", text)) / chars,
        punctuation / n, rule_row(text)[1] / n,
    )


def forest_score(text, model):
    """Mean path length of the text's statistics in the model's trees, node by node, as a score."""
    point = [
        math.log(1 + abs(x - c) / u) for x, c, u in zip(rule_statistics(text), model.scale.centre, model.scale.unit)
    ]
    forest, total = model.forest, 0.0
    for feature, cut, child, path in zip(forest.feature, forest.cut, forest.child, forest.path):
        at = 0
        while child[at]:
            at = child[at] + (point[feature[at]] > cut[at])
        total += path[at]
    n = forest.rows
    usual = 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n
    return 2 ** (-total / len(forest.path) / usual)


def cut_repeats(texts, length):
    datas = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + length] for d in datas for i in range(len(d) - length + 1))
    out = []
    for d in datas:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(d), len(d) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def near_groups(rows):
    """{doc_id: (fingerprint, component)} of rows (doc_id, text)."""
    fps = {d: fingerprint(t) for d, t in rows}
    links = [(a, b) for a, b in combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 3]
    comp = union(links, fps)
    return {d: (f"{f:016x}", comp[d]) for d, f in fps.items()}


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def dedup_lines(rows):
    """[(doc_id, lines, dropped, kept text)] of rows (doc_id, text)."""
    docs = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(line_key(line)) >= 20:
                docs[line_key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(docs[line_key(x)]) < 3 or max(docs[line_key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def targets(sizes):
    """{source: target} of {source: size}, by sharing the excess again and again."""
    ranked = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(ranked)}
    total, full = sum(sizes.values()), set()
    while True:
        free = sum(weight[s] for s in ranked if s not in full)
        left = total - sum(3 * sizes[s] for s in full)
        share = {s: 3 * sizes[s] if s in full else left * weight[s] / free for s in ranked}
        over = {s for s in ranked if s not in full and share[s] >= 3 * sizes[s]}
        if not over:
            return share
        full |= over


def mix(rows):
    """[(doc_id, source, text, copies)] of rows (doc_id, source, text); copies: words of each copy taken."""
    sized = [(d, s, t, len(WORD.findall(t or ""))) for d, s, t in rows]
    totals = Counter()
    for _, s, _, n in sized:
        totals[s] += n
    goal, out = targets(totals), []
    for source in totals:
        own = sorted((r for r in sized if r[1] == source), key=lambda r: (hashlib.md5(f"mix{r[0]}".encode()).hexdigest(), str(r[0]), r[3]))
        start, demand = 0, int(goal[source] + 0.5)
        for d, s, t, n in own:
            copies = [min(max(demand - start - e * totals[source], 0), n) for e in range(3)]
            out.append((d, s, t, [c for c in copies if c > 0]))
            start += n
    return out


def first_words(text, n):
    ends = [m.end() for m in WORD.finditer(text)]
    return text[: ends[n - 1]] if n < len(ends) else text


def tiktoken_encoding(name="byte_bpe_multi_50k.tiktoken"):
    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def secret_spans(text, rules):
    """Spans (start, order, end, kind) of every rule's matches."""
    out = []
    for n, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or ""):
            if len(m.group(r.group)) >= r.least:
                out.append((m.start(), n, m.end(), r.kind))
    return sorted(out)


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked_search(docs, items, k):
    """(item_id, rank, doc_id, score) from (id, text) rows on both sides."""
    terms = [Counter(TERM.findall((t or "").translate(LOWER))) for _, t in docs]
    total = [sum(c.values()) for c in terms]
    n_docs, n_terms = sum(n > 0 for n in total), sum(total)
    df = Counter(t for c in terms for t in c)
    out = []
    for item_id, text in set(items):
        scores = []
        for (doc_id, _), c, n in zip(docs, terms, total):
            score = 0
            for t, times in Counter(TERM.findall((text or "").translate(LOWER))).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * (75 + 25 * n * n_docs // n_terms)))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item_id, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def collocations(docs, least, top=2000):
    """(lang, rank, phrase, k, a, l, r, n, score) from (lang, text) rows."""
    counts, total = Counter(), Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[ \t]", piece) if w]
            total[lang or "und"] += len(words)
            for k in range(1, 5):
                counts.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {p: f for p, f in counts.items() if f >= least and len(p[1]) > 1}
    dropped = set()
    for (lang, p), f in candidates.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                sub = lang, p[i : i + size]
                if 100 * f >= 80 * counts[sub]:
                    dropped.add(sub)
    rows = defaultdict(list)
    for (lang, p), a in candidates.items():
        if (lang, p) not in dropped:
            score, cut = min((2_000_000 * a // (counts[lang, p[:c]] + counts[lang, p[c:]]), c) for c in range(1, len(p)))
            rows[lang].append((-score, -a, " ".join(p).encode(), len(p), counts[lang, p[:cut]], counts[lang, p[cut:]]))
    return [
        (lang, i + 1, p.decode(), k, -a, l, r, total[lang], -score)
        for lang, own in rows.items() for i, (score, a, p, k, l, r) in enumerate(sorted(own)[:top])
    ]
