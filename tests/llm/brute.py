"""Plain versions of the operators, for comparison on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

BLANK = r"[^\x20\x09-\x0D]+"
PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def fold(doc_id, parts):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts


def contamination(docs, items, window=13):
    windows = {}
    for item_id, text in items:
        w = re.findall(PLAIN, lower(text))
        for part in [tuple(w[i : i + window]) for i in range(len(w) - window + 1)] or ([tuple(w)] if w else []):
            windows.setdefault(part, set()).add(str(item_id))
    out = []
    for doc_id, text in docs:
        w = re.findall(PLAIN, lower(text))
        hit, found = [0] * len(w), set()
        for n in sorted({len(k) for k in windows}):
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    found |= windows[tuple(w[i : i + n])]
                    hit[i : i + n] = [1] * n
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), sum(hit), len(found), digest, sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out


def fingerprint(text):
    import xxhash

    w = re.findall(BLANK, lower(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fingerprints, distance=2):
    root = {f: f for f in fingerprints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    return {f: find(f) for f in distinct}


def base_scores(docs, parts=5, held=1):
    tokens = {d: [*re.findall(BLANK, lower(t)), "\n"] for d, t in docs}
    counts = Counter()
    for d, t in tokens.items():
        if fold(d, parts) != held:
            counts.update(t)
    total, size = sum(counts.values()), len(counts)
    return {
        d: (fold(d, parts) == held, len(t), sum(counts[w] > 0 for w in t), total, sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (size + 1))) for w in t))
        for d, t in tokens.items()
    }


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def personal_data(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def auc(labels, scores):
    pairs = sorted(zip(scores, labels, strict=True))
    ones = sum(labels)
    ranks = sum(i for i, (_, y) in enumerate(pairs) if y)
    return (ranks - ones * (ones - 1) / 2) / (ones * (len(labels) - ones))
