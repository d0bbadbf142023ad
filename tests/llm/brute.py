"""Plain single-process versions of the operators' contracts, for small tables only."""

from __future__ import annotations

import hashlib
import re
import struct
from zlib import crc32

import numpy as np

WS = re.compile(r"[^\x20\x09-\x0D]+")
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii_base(text: str | None) -> list[tuple[int, int, int, str]]:
    out = []
    for no, (kind, rx) in enumerate(PII.items()):
        for m in re.finditer(rx, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": lambda: True,
                  "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                  "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                  "phone": lambda: 9 <= len(digits) <= 15}[kind]()
            if ok:
                out.append((m.start(), no, m.end(), kind))
    return sorted(out)


def spans_text(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def rule_measures(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = WS.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WS.search(line):
            dup += line in seen
            seen.add(line)
    grams: dict[tuple, list[int]] = {}
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i:i + 3]), []).append(i)
    hit = {i + d for at in grams.values() if len(at) > 1 for i in at for d in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit))


def simhash(text: str | None) -> int:
    import xxhash

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WS.findall(low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids: list, values: list[int], bits: int = 4) -> dict:
    """Smallest id of each value's class under Hamming distance <= bits."""
    distinct = sorted(set(values))
    arr = np.array(distinct, np.uint64)
    parent = list(range(len(distinct)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(distinct)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= bits):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    place = {v: k for k, v in enumerate(distinct)}
    low: dict[int, int] = {}
    for i, v in zip(ids, values):
        r = find(place[v])
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return {v: low.get(find(place[v])) for v in distinct}


def substrings(docs: list[tuple[int, bytes]], n: int = 100) -> dict[int, tuple[int, int, int, str]]:
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256) of exact substring dedup."""
    first: dict[bytes, tuple[int, int]] = {}
    for d, t in sorted(docs):
        for p in range(len(t) - n + 1):
            first.setdefault(t[p:p + n], (d, p))
    out = {}
    for d, t in docs:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - n + 1):
            if first[t[p:p + n]] < (d, p):
                gone[p:p + n] = True
        spans = int(np.sum(gone & ~np.concatenate([[False], gone[:-1]]))) if len(t) else 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone]) if len(t) else b""
        out[d] = (len(t), int(gone.sum()), spans, sha(kept))
    return out


def ids_crc(ids: list[int]) -> int:
    return crc32(struct.pack(f"<{len(ids)}I", *ids))
