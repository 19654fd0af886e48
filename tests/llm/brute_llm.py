"""The dealt operators by brute force, in plain Python over small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CAPITALS = {c: c + 32 for c in range(65, 91)}


def small(text):
    return (text or "").translate(CAPITALS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal_data(text):
    """(n_email, n_ip, n_card, n_phone, listed base spans)."""
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    kinds = Counter(k for _, k, _ in found)
    names = ["email", "ip", "card", "phone"]
    return (*(kinds[k] for k in range(4)), ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(found)))


def pieces(texts, tokenizer, capacity=4096, end_id=1):
    """Counter of (doc_id, piece, start, length, crc) of {doc_id: text}."""
    out = Counter()
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
            out[doc_id, n, at, len(part), crc] += 1
    return out


def shingles(text, n=4):
    words = SPACE_WORD.findall(small(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def near_duplicates(texts, n=4, percent=85):
    """{doc_id: (n_shingles, component_id)} of {doc_id: text}."""
    sets = {d: shingles(t, n) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    shared = Counter()
    for group in holders.values():
        for i, a in enumerate(group):
            for b in group[:i]:
                shared[min(a, b), max(a, b)] += 1
    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def repeated_passages(texts, window=50):
    """{doc_id: (n_words, n_removed, kept_sha256)} of {doc_id: text}."""
    words = {d: SPACE_WORD.findall(t or "") for d, t in texts.items()}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out[d] = (len(w), len(gone), sha(" ".join(kept)))
    return out


def contamination(texts, items, window=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}."""
    wanted = defaultdict(set)
    for item, text in items:
        w = ALNUM_WORD.findall(small(text))
        if w:
            n = min(window, len(w))
            for i in range(len(w) - n + 1):
                wanted[tuple(w[i : i + n])].add(item)
    sizes = {len(x) for x in wanted}
    out = {}
    for d, text in texts.items():
        w, hit, found = ALNUM_WORD.findall(small(text)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (x := tuple(w[i : i + n])) in wanted:
                    hit.update(range(i, i + n))
                    found |= wanted[x]
        out[d] = (len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit))
    return out


def base_scores(texts):
    """{doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}."""
    import math

    tokens = {d: [*SPACE_WORD.findall(small(t)), None] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in texts}
    counts = Counter(x for d, w in tokens.items() if not held[d] for x in w)
    n, v = sum(counts.values()), len(counts)
    return {
        d: (held[d], len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
        for d, w in tokens.items()
    }
