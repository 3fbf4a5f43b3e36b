"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import tiktoken
import xxhash

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def tokenizer() -> tiktoken.Encoding:
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def bench_words(text: str | None) -> list[str]:
    return _BENCH_WORD.findall((text or "").translate(_LOWER))


def contamination(documents, items):
    """{row number: (words, hit words, item ids)}"""
    windows: dict[tuple, set[str]] = {}
    for item, text in items:
        words = bench_words(text)
        for i in range(max(1, len(words) - 9) if words and item is not None else 0):
            windows.setdefault(tuple(words[i : i + 10]), set()).add(str(item))
    out = []
    for _, text in documents:
        words, hit, met = bench_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found:
                    met |= found
                    hit |= set(range(i, i + size))
        out.append((len(words), len(hit), sorted(met)))
    return out


def byte_repeats(texts, length=200):
    """(bytes, removed, spans, digest) per text."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        marks = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                marks[i : i + length] = b"\1" * length
        spans = sum(1 for i, m in enumerate(marks) if m and (i == 0 or not marks[i - 1]))
        kept = bytes(b for b, m in zip(d, marks) if not m)
        out.append((len(d), sum(marks), spans, sha(kept)))
    return out


def word_repeats(documents, size=13):
    """(words, removed, digest) per document; no id counts as the largest."""
    words = [_WORD.findall(t or "") for _, t in documents]
    ids = [2**63 - 1 if d is None else d for d, _ in documents]
    least: dict[tuple, int] = {}
    for doc, w in zip(ids, words):
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            least[key] = min(least.get(key, doc), doc)
    out = []
    for doc, w in zip(ids, words):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if least[tuple(w[i : i + size])] < doc:
                gone[i : i + size] = [True] * size
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((len(w), sum(gone), sha(" ".join(kept).encode())))
    return out


def fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(n: int, linked) -> list[int]:
    """The first member of each member's group; ``linked(i, j)`` tells links."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def named_groups(ids, roots):
    """The smallest id of each member's group, None if it has none."""
    least: dict[int, int] = {}
    for doc, root in zip(ids, roots):
        if doc is not None:
            least[root] = min(least.get(root, doc), doc)
    return [least.get(root) for root in roots]


def prose(seed: int, words: int, vocabulary: int = 4000) -> str:
    chance = random.Random(seed)
    return " ".join(f"w{chance.randrange(vocabulary):x}{chance.choice(['', '', ',', '.'])}" for _ in range(words))


def trie(rows):
    """Nodes of (conv_id, turn, role, text) rows, as in the operator's columns."""
    turns: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = sha(f"{len(role)}:{role}{text}".encode())
            turns.setdefault(conv, []).append(((turn is not None, turn or 0), role, digest, text))
    own = {conv: [(role, text) for _, role, _, text in sorted(t)] for conv, t in turns.items()}
    members: dict[tuple, list[int]] = {}
    built = {}
    for conv, t in own.items():
        base = conv - (abs(conv) % 100) * (1 if conv >= 0 else -1)
        share = zlib.crc32(str(conv).encode()) % 6
        built[conv] = tuple(own.get(base, [])[:share] + t[share:])
        for depth in range(len(built[conv]) + 1):
            members.setdefault(built[conv][:depth], []).append(conv)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    return Counter(
        (
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node],
            leaves[node], saved[node],
            sha(",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node)).encode()),
        )
        for node, convs in members.items()
    )


def whitened(vectors, components=32):
    """(n, deviations, whitened up to sign, shares) by plain whole numbers and one eigh."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n = len(x)
    sums = [sum(column) for column in zip(*x)]
    centred = [[n * a - s for a, s in zip(row, sums)] for row in x]
    exact = [[sum(a * b for a, b in zip(p, q)) for q in zip(*centred)] for p in zip(*centred)]
    covariance = np.array([[value / n**3 for value in line] for line in exact])
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    plain = np.array([[a / n for a in row] for row in centred])
    return (
        n, [sum(a * a for a in row) for row in centred],
        plain @ axes[:, order] / np.sqrt(values[order]), values[order] / np.trace(covariance),
    )


def representatives(rows):
    """Of each SimHash group of (id, text) rows the first by id (none last) and XXH64 of the text."""
    prints = [fingerprint(text) for _, text in rows]
    roots = groups(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)

    def order(row):
        doc, text = row
        digest = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
        return doc is None, doc or 0, digest - (1 << 64) if digest >> 63 else digest

    least: dict[int, tuple] = {}
    for row, root in zip(rows, roots):
        least[root] = min(least.get(root, row), row, key=order)
    return list(least.values())


class _Plain(HTMLParser):
    """Blocks of well-formed pages, with their whole paths as texts."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks, self.text, self.links, self.linked = [], [], "", 0, 0

    def finish(self):
        text = " ".join(self.text.split())
        if text and not {"nav", "footer", "aside", "form"} & set(self.open):
            self.blocks.append(("/".join(self.open), text, min(self.linked, len(text)), "article" in self.open))
        self.text, self.linked = "", 0

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.links += 1
        elif tag not in ("b", "i"):
            self.finish()
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag == "a":
            self.links -= 1
        elif tag not in ("b", "i"):
            self.finish()
            self.open.pop()

    def handle_data(self, data):
        self.text += data
        if self.links:
            self.linked += len(data.strip())


def main_text(page, share, given, beyond, marks):
    """Tag-path ratios of a well-formed page whose articles, if any, all count: path by path, block by block."""
    reader = _Plain()
    reader.feed(page)
    reader.finish()
    blocks = reader.blocks
    some = any(b[3] for b in blocks)
    group = [(path, within or not some) for path, _, _, within in blocks]
    mean = lambda values: sum(values) / len(values)
    ratios = {}
    for g in set(group):
        own = [b for b, h in zip(blocks, group) if h == g]
        ratios[g] = (mean([len(t) - n for _, t, n, _ in own]), mean([len(marks.findall(t)) for _, t, _, _ in own]))
    line = [ratios[g] for g in group]
    smooth = []
    for i in range(len(line)):
        near = [line[min(max(i + d, 0), len(line) - 1)] for d in (-2, -1, 0, 1, 2)]
        smooth.append([sum(w * r[k] for w, r in zip((1, 4, 6, 4, 1), near)) / 16 for k in (0, 1)])
    fused = {}
    for g in set(group):
        length, punctuation = ([s[k] for s, h in zip(smooth, group) if h == g] for k in (0, 1))
        fused[g] = math.sqrt(mean(length) * (1 + mean(punctuation)))
    best = max(fused.values(), default=0) or 1
    out = []
    for (path, text, _, _), g in zip(blocks, group):
        own = [b for b, h in zip(blocks, group) if h == g]
        unlinked = sum(len(t) - n for _, t, n, _ in own) / sum(len(t) for _, t, _, _ in own)
        last = path.split("/")[-1]
        score = fused[g] / best
        if some and g[1]:
            part = given(last)
            score = (part + (1 - part) * score) * (unlinked if last in ("li", "div", "section", "article", "ul") else 1)
        elif some:
            score *= beyond * unlinked
        if score >= share:
            out.append(text)
    return out
