"""Plain single-process versions of the operators, for comparison."""

from __future__ import annotations

import hashlib


def remove_repeats(docs, length):
    """docs: (doc_id, text) pairs -> (doc_id, n_bytes, n_removed, n_spans, sha)."""
    rows = sorted((i is None, i or 0, (t or "").encode()) for i, t in docs)
    seen, out = set(), []
    for null, i, text in rows:
        gone = bytearray(len(text))
        for p in range(len(text) - length + 1):
            w = text[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((None if null else i, len(text), sum(gone), spans,
                    hashlib.sha256(kept).hexdigest()))
    return out


def simhash(text, shingle):
    import re

    import xxhash
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(docs, shingle, max_bits):
    prints = [simhash(t, shingle) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(docs, prints))]


def bench_words(text):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def decontaminate(docs, items, window):
    held = {}
    for i, t in items:
        ws = bench_words(t)
        for k in range(max(1, len(ws) - window + 1) if ws else 0):
            held.setdefault(tuple(ws[k:k + window]), set()).add(i)
    sizes = {len(w) for w in held}
    out = []
    for d, t in docs:
        ws, hit, ids = bench_words(t), set(), set()
        for size in sizes:
            for k in range(len(ws) - size + 1):
                got = held.get(tuple(ws[k:k + size]))
                if got:
                    hit.update(range(k, k + size))
                    ids |= {str(x) for x in got if x is not None}
        out.append((d, len(ws), len(hit), len(ids),
                    hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out
