"""Plain Python versions of what the operators return, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def components(nodes, links):
    """Smallest reachable node of each node."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def fingerprint(text, size=3):
    found = words((text or "").translate(LOWER))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(docs):
    prints = {i: fingerprint(t) for i, t in docs}
    ids = sorted(prints)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if (prints[a] ^ prints[b]).bit_count() <= 2]
    group = components(ids, links)
    return {i: (f"{prints[i]:016x}", group[i]) for i in ids}


def token_files(docs, tokenizer, end_id):
    out, start = {}, 0
    for i, text in sorted(docs):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out[i] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    return out


def bpe(docs, tokenizer):
    out = {}
    for i, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)]
        out[i] = (len(ids), *sha)
    return out


def unigram(docs):
    """n_tokens, n_known, train_tokens, base_score by document."""
    counts = Counter()
    for i, text in docs:
        if remainder(i, 7) != 2:
            counts.update(words((text or "").translate(LOWER)) + [""])
    n, v, out = sum(counts.values()), len(counts), {}
    for i, text in docs:
        tokens = words((text or "").translate(LOWER)) + [""]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        out[i] = (len(tokens), sum(counts[t] > 0 for t in tokens), n, base)
    return out


def bigram(docs, training, weights, bucket):
    """Interpolated log10 probability of every document with given weights."""
    single, pairs = Counter(), Counter()
    starts = 0
    for (i, text), learn in zip(docs, training):
        if learn:
            tokens = ["<s>"] + words((text or "").translate(LOWER)) + [""]
            starts += 1
            single.update(tokens[1:])
            pairs.update(zip(tokens[:-1], tokens[1:]))
    n, v, out = sum(single.values()), len(single), {}
    for i, text in docs:
        tokens = ["<s>"] + words((text or "").translate(LOWER)) + [""]
        total = 0.0
        for h, w in zip(tokens[:-1], tokens[1:]):
            c = starts if h == "<s>" else single[h]
            a, b, d = weights[bucket(c)]
            total += math.log10(a * pairs[h, w] / max(c, 1) + b * single[w] / max(n, 1) + d / (v + 1))
        out[i] = total
    return out


def measures(text):
    found = words(text)
    windows = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    inside = {i + k for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for k in range(3)}
    seen, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            duplicates += line in seen
            seen.add(line)
    failed = len(found) < 50 or 100 * len(inside) > 50 * len(found)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(found), sum(map(len, found)), symbols, duplicates, len(inside), failed


def line_verdicts(rows, max_docs=20, min_left=0.3):
    """``(host, text) -> (set of removed lines, kept)``: every pair of texts and lines is looked at."""
    def plain(line):
        return tuple(re.sub("[0-9]", "0", line.lower()).split())

    texts = {(h, t or ""): {} for h, t in rows}
    for (h, t), lines in texts.items():
        for x in t.split("\n"):
            if x.split():
                lines[plain(x)] = lines.get(plain(x), 0) + len(x.split())
    inside = {}
    for (h, t), lines in texts.items():
        for x in lines:
            inside.setdefault((h, x), set()).add(t)
    shared = {}
    for (h, x), ts in inside.items():
        if len(ts) > 1:
            shared.setdefault(h, []).append(x)

    def is_version(h, x):
        return len(x) >= 5 and any(len(y) >= 5 and (x[:5] == y[:5] or x[-5:] == y[-5:]) for y in shared.get(h, []))

    votes = {}
    for (h, t), lines in texts.items():
        common = [x for x in lines if len(inside[h, x]) > max_docs]
        own = {x: n for x, n in lines.items() if len(inside[h, x]) == 1}
        edited = sum(n for x, n in own.items() if is_version(h, x))
        document = ("text", t)
        if not own or 2 * edited >= sum(own.values()):
            order = sorted((len(inside[h, x]), x) for x in lines if x not in own)
            total, up_to = sum(lines[x] for _, x in order), 0
            for _, x in order:
                up_to += lines[x]
                if 4 * up_to >= total:
                    document = ("copy", x)
                    break
        for x in common:
            votes.setdefault((h, x), set()).add(document)
    found = {}
    for (h, t), lines in texts.items():
        gone = {x for x in lines if len(votes.get((h, x), ())) > max_docs}
        n = sum(lines.values())
        n_words, _, _, _, repeated, failed = measures(t)
        found[h, t] = (gone, not failed and n - sum(lines[x] for x in gone) >= min_left * n)
    return found
