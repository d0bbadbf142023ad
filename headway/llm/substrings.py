"""Exact substring deduplication with suffix arrays over content-defined shards.

A byte goes if some ``LENGTH``-byte string that covers it also starts earlier in the corpus (smaller
doc_id, or same document and earlier start), judged on the input.

*Sharding*: equal strings must meet in one shard, so shards follow content.  Of the ``GRAM``-byte grams of
every window of ``LENGTH`` bytes the one of smallest hash (leftmost on ties) is the window's anchor; it
depends on the window alone.  Consecutive windows with one anchor form a *chunk* of at most
``2 * LENGTH - GRAM`` windows' bytes.  Chunks meet by anchor hash.  An anchor that occurs once cannot hold
a repeated string; of chunks equal in all bytes, all but the first repeat the first.

*Suffix arrays*: what remains, the first occurrences of differing chunks that share an anchor, is dealt to
shards by anchor hash.  Each shard's suffix array is built by induced sorting and its permuted common
prefixes are computed (``suffix_array``); suffixes whose common prefixes reach ``LENGTH`` are one class, in
which all but the earliest are repeats.

*Hot content*: chunks equal within one batch are combined before the shuffle, and the later ones go on
under a hash of their own place, so a passage in a third of all documents is one row per batch.  The
reducing step streams sorted rows.  An anchor with more than ``SHARD_MAX`` bytes of differing chunks does not
go to a suffix array: its windows are grouped by digest with partially aggregated minima, all of them.

Chunk and window digests are 64 and 128 bits; a collision could remove a byte wrongly, with a
probability of about 2^-20 for a corpus of 10^13 bytes per shared anchor.

Defined cases: null text is empty; null doc_ids sort last; rows equal in doc_id and text are one
document (all get its spans, none erases another); different texts of one doc_id are documents ordered
by ``sign``, the 64-bit hash of their text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm import suffix_array
from headway.llm.common import buffers, prepare, stored

LENGTH = 100
GRAM = 32
WINDOWS = LENGTH - GRAM + 1          # grams in a window, and most windows in a chunk
SEGMENT = 1 << 20                    # bytes hashed at a time
SHARD_BYTES = 1 << 20                # suffix arrays are built over about this many bytes
SHARD_MAX = 8 << 20                  # differing chunks of one anchor beyond this are grouped by window
COUNT_BITS = 7                       # a place packs a start and, in the low bits, a number of windows
BASE = 0x9E3779B97F4A7C15 | 1
_COPY = 0                            # digest of rows that are later copies already


# ---------------------------------------------------------------- chunks

@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    def run(x: int) -> np.ndarray:
        p = np.full(SEGMENT + 2 * LENGTH, x, np.uint64)
        p[0] = 1
        return np.multiply.accumulate(p)

    return run(BASE), run(pow(BASE, -1, 1 << 64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def chunks(raw: np.ndarray, doc_end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Chunks of a byte vector: anchor hash, digest, first window, number of windows.  ``doc_end`` gives for
    every byte the end of its document; only windows inside one document count."""
    n = len(raw)
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n < LENGTH:
        return none
    power, inverse = _powers()
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    grams = _mix((sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1])
    place_bits = np.uint64(21)
    low = (grams >> place_bits << place_bits) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width < WINDOWS:                                     # sliding minimum by doubling
        step = min(width, WINDOWS - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    anchor = (low & np.uint64((1 << 21) - 1)).astype(np.int64)
    anchor[np.arange(len(anchor)) + LENGTH > doc_end[: len(anchor)]] = -1
    cut = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.concatenate([cut, [len(anchor)]]))
    real = anchor[cut] >= 0
    first, count = cut[real], count[real]
    if not len(first):
        return none
    end = first + count - 1 + LENGTH
    digest = _mix((sums[end] - sums[first]) * inverse[first] + count.astype(np.uint64))
    digest[digest == _COPY] = 1
    return grams[anchor[first]], digest, first, count


def _pack(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (start << COUNT_BITS) | count


def _segments(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, document number of every byte, start of every byte in its document) of at most SEGMENT
    windows; a document's segments overlap by LENGTH - 1 bytes, so each window is in exactly one."""
    raw, off = buffers(col)
    docs = len(off) - 1
    a = 0
    while a < docs:
        size = off[a + 1] - off[a]
        if size > SEGMENT:
            for at in range(0, int(size) - LENGTH + 1, SEGMENT):
                part = raw[off[a] + at: min(off[a] + at + SEGMENT + LENGTH - 1, off[a + 1])]
                yield part, np.full(len(part), a), np.arange(at, at + len(part))
            a += 1
            continue
        b = max(a + 1, int(np.searchsorted(off, off[a] + SEGMENT, "right")) - 1)
        part = raw[off[a]: off[b]]
        doc = np.repeat(np.arange(a, b), np.diff(off[a: b + 1]))
        yield part, doc, np.arange(len(part)) + off[a] - off[doc]
        a = b


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, sign, text) -> (hash, digest, doc, sign, place), chunks equal within a batch combined."""
    for b in batches:
        docs = b.column(0).to_numpy()
        signs = b.column(1).to_numpy()
        found = []
        for raw, doc, start in _segments(b.column(2)):
            new_doc = np.flatnonzero(np.concatenate([doc[1:] != doc[:-1], [True]])) if len(doc) else np.zeros(0, int)
            ends = np.repeat(new_doc + 1, np.diff(np.concatenate([[-1], new_doc])))
            h, d, first, count = chunks(raw, ends)
            if len(h):
                found.append((h.view(np.int64), d.view(np.int64), docs[doc[first]], signs[doc[first]],
                              _pack(start[first], count)))
        if not found:
            continue
        h, d, doc, sign, place = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((place, sign, doc, d, h))
        h, d, doc, sign, place = h[order], d[order], doc[order], sign[order], place[order]
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
        again = same.copy()                                                # equal rows are one document
        again[1:] &= (doc[1:] == doc[:-1]) & (sign[1:] == sign[:-1]) & (place[1:] == place[:-1])
        first_of = np.maximum.accumulate(np.where(same, -1, np.arange(len(h))))
        later = same & ~((doc == doc[first_of]) & (sign == sign[first_of]) & (place == place[first_of]))
        h = np.where(later, _mix((place ^ (doc * 31) ^ sign).view(np.uint64)).view(np.int64), h)
        d = np.where(later, _COPY, d)
        keep = ~again & ~(same & ~later)
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (h, d, doc, sign, place)],
                                         names=["hash", "digest", "doc", "sign", "place"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (hash, digest, doc, sign, place) -> repeats (hash null) and first occurrences of
    differing chunks of one anchor (hash set)."""
    last = None                     # last row: hash, digest, and doc, sign, place of its chunk's first occurrence
    pending = None                  # first chunk of the last anchor, not yet known to have a differing one

    def rows(h, *where):
        if len(where[0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(h, pa.int64()) if h is not None else pa.nulls(len(where[0]), pa.int64()),
                 *(pa.array(x) for x in where)], names=["hash", "doc", "sign", "place"])

    for b in batches:
        h, d, *where = (b.column(i).to_numpy() for i in range(5))
        copy = d == _COPY
        yield from rows(None, *(x[copy] for x in where))
        h, d, *where = (x[~copy] for x in (h, d, *where))
        n = len(h)
        if not n:
            continue
        new = np.ones(n, bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        if last is not None and (h[0], d[0]) == last[:2]:
            new[0] = False
        at = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        first = [np.where(at >= 0, x[np.maximum(at, 0)], last[2 + i] if last is not None else 0)
                 for i, x in enumerate(where)]
        repeat = ~new & ~np.logical_and.reduce([x == y for x, y in zip(where, first)])
        yield from rows(None, *(x[repeat] for x in where))
        last = (h[-1], d[-1], *(x[-1] for x in first))
        starts = np.flatnonzero(new)
        held = [h[starts], *(x[starts] for x in where)]
        if pending is not None:
            held = [np.concatenate([[x], y]) for x, y in zip(pending[0], held)]
        sh = held[0]
        if not len(sh):
            continue
        equal = sh[1:] == sh[:-1]
        many = np.zeros(len(sh), bool)
        many[1:] |= equal
        many[:-1] |= equal
        out = many.copy()
        if pending is not None and pending[1]:
            out[0] = False                                     # already given out
            many[0] = True
        yield from rows(*(x[out] for x in held))
        pending = ([x[-1] for x in held], bool(many[-1]))


# ---------------------------------------------------------------- suffix arrays

def _shard_repeats(texts: list[bytes], order: np.ndarray) -> list[np.ndarray]:
    """For each chunk, which of its windows start a string that an earlier chunk (smaller order) has."""
    s, starts = suffix_array.join(texts)
    sa = suffix_array.suffix_array(s)
    prefix = suffix_array.common_prefixes(s, sa)
    chunk = np.searchsorted(starts, np.arange(len(s)), "right") - 1
    joined = prefix >= LENGTH
    group = np.cumsum(~joined)                                 # classes of equal LENGTH-byte prefixes
    size = np.bincount(group)
    mine = np.flatnonzero(size[group] > 1)
    pos, group = sa[mine], group[mine]
    out = [np.zeros(max(0, len(t) - LENGTH + 1), bool) for t in texts]
    if not len(pos):
        return out
    age = order[chunk[pos]]
    cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.repeat(np.minimum.reduceat(age, cut), np.diff(np.concatenate([cut, [len(pos)]])))
    for p, c in zip(pos[age != least].tolist(), chunk[pos[age != least]].tolist()):
        out[c][p - starts[c]] = True
    return out


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - edge[::2]).tolist()))


def _shards(shard_bytes: int, shard_max: int):
    """Chunks sorted by anchor hash -> repeats (text null), or chunks of an anchor too large for one suffix
    array as they came (text set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "sign", "place", "text"]
        open_: list[tuple[int, int, int, int, bytes]] = []
        size, group_size, group, spilling = 0, 0, None, False

        def solve(rows: list) -> Iterator[pa.RecordBatch]:
            if len(rows) < 2:
                return
            doc = np.array([r[1] for r in rows])
            sign = np.array([r[2] for r in rows])
            place = np.array([r[3] for r in rows])
            order = np.empty(len(rows), np.int64)
            order[np.lexsort((place, sign, doc))] = np.arange(len(rows))
            docs, signs, places = [], [], []
            for r, flags in zip(rows, _shard_repeats([r[4] for r in rows], order)):
                for at, count in _runs(flags):
                    docs.append(r[1])
                    signs.append(r[2])
                    places.append((r[3] >> COUNT_BITS << COUNT_BITS) + (at << COUNT_BITS) + count)
            if docs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(signs, pa.int64()), pa.array(places, pa.int64()),
                     pa.nulls(len(docs), pa.binary())], names=names)

        def whole(rows: list) -> Iterator[pa.RecordBatch]:
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2, 3)),
                     pa.array([r[4] for r in rows], pa.binary())], names=names)

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(5))):
                if row[0] != group:
                    if spilling:
                        yield from whole(open_)
                        open_, size, spilling = [], 0, False
                    elif size >= shard_bytes:
                        yield from solve(open_)
                        open_, size = [], 0
                    group, group_size = row[0], 0
                open_.append(row)
                size += len(row[4])
                group_size += len(row[4])
                if group_size > shard_max:
                    if not spilling:
                        spilling = True
                        yield from solve([r for r in open_ if r[0] != group])
                        open_ = [r for r in open_ if r[0] == group]
                    if len(open_) >= 1000:
                        yield from whole(open_)
                        open_ = []
        yield from (whole(open_) if spilling else solve(open_))

    return run


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, sign, place, text) chunks -> one row per window with its 128-bit digest."""
    for b in batches:
        for doc, sign, place, text in zip(*(b.column(i).to_pylist() for i in range(4))):
            n = len(text) - LENGTH + 1
            d = np.frombuffer(b"".join(hashlib.blake2b(text[i: i + LENGTH], digest_size=16).digest()
                                       for i in range(n)), np.int64).reshape(n, 2)
            at = (place >> COUNT_BITS << COUNT_BITS) + (np.arange(n) << COUNT_BITS) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()), pa.array(np.full(n, doc)), pa.array(np.full(n, sign)),
                 pa.array(at)], names=["d1", "d2", "doc", "sign", "place"])


# ---------------------------------------------------------------- texts and spans

def _keyed(docs: DataFrame) -> DataFrame:
    """(doc, sign, text bytes): null doc_ids get the largest number."""
    body = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
                       F.xxhash64(body).alias("sign"), F.col("doc_id"), body.alias("body"))


def _packed(rows: DataFrame) -> DataFrame:
    """The last column compressed: texts travel through shuffles as zstd frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            last = [squeeze(t) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(last, pa.binary())], names=b.schema.names)

    return rows.mapInArrow(run, rows.schema)


def _cut_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, sign, wanted[(hash, place)], zstd body) -> (hash, doc, sign, place, text) chunks."""
    open_ = zstandard.ZstdDecompressor()
    for b in batches:
        for doc, sign, wanted, body in zip(*(b.column(i).to_pylist() for i in range(4))):
            text = open_.decompress(body)
            hashes = [w["hash"] for w in wanted]
            places = [w["place"] for w in wanted]
            cut = []
            for p in places:
                start = p >> COUNT_BITS
                cut.append(text[start: start + (p & ((1 << COUNT_BITS) - 1)) - 1 + LENGTH])
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.int64()), pa.array([doc] * len(places), pa.int64()),
                 pa.array([sign] * len(places), pa.int64()), pa.array(places, pa.int64()), pa.array(cut, pa.binary())],
                names=["hash", "doc", "sign", "place", "text"])


def repeated_windows(docs: DataFrame, shard_bytes: int = SHARD_BYTES, shard_max: int = SHARD_MAX) -> DataFrame:
    """(doc, sign, place): runs of windows that also start earlier; see ``_pack`` for places."""
    keyed = _keyed(docs)
    rows = keyed.select("doc", "sign", "body").mapInArrow(
        _chunk_rows, "hash long, digest long, doc long, sign long, place long")
    sorted_rows = rows.repartition("hash").sortWithinPartitions("hash", "digest", "doc", "sign", "place")
    met = stored(sorted_rows.mapInArrow(_compare, "hash long, doc long, sign long, place long"), "substrings-met")
    wanted = (met.where("hash is not null").groupBy("doc", "sign")
              .agg(F.collect_list(F.struct("hash", "place")).alias("wanted"))
              .withColumnsRenamed({"doc": "__doc", "sign": "__sign"}))
    texts = _packed(keyed.select("doc", "sign", "body"))
    held = texts.join(wanted, (F.col("doc") == F.col("__doc")) & (F.col("sign") == F.col("__sign")))
    one = held.dropDuplicates(["doc", "sign"]).select("doc", "sign", "wanted", "body")
    cut = one.mapInArrow(_cut_chunks, "hash long, doc long, sign long, place long, text binary")
    solved = stored(cut.repartition("hash").sortWithinPartitions("hash").mapInArrow(
        _shards(shard_bytes, shard_max), "doc long, sign long, place long, text binary"), "substrings-solved")
    windows = solved.where("text is not null").mapInArrow(
        _windows, "d1 long, d2 long, doc long, sign long, place long")
    least = windows.groupBy("d1", "d2").agg(F.min(F.struct("doc", "sign", "place")).alias("least"))
    large = (windows.join(least, ["d1", "d2"])
             .where(F.struct("doc", "sign", "place") != F.col("least")).select("doc", "sign", "place"))
    return (met.where("hash is null").select("doc", "sign", "place")
            .union(solved.where("text is null").select("doc", "sign", "place")).union(large))


def _erase(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for body, places in zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                text = open_.decompress(body)
                n = len(text)
                if not places:
                    out.append((n, 0, 0, hashlib.sha256(text).hexdigest(), text))
                    continue
                p = np.array(places, np.int64)
                start = p >> COUNT_BITS
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + (p & ((1 << COUNT_BITS) - 1)) - 1 + LENGTH, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                spans = int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]])))
                out.append((n, n - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            cols = [pa.array([o[i] for o in out], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            k = 5 if keep_text else 4
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], *cols[:k]], names=[*b.schema.names[:-2], *names[:k]])

    return run


def deduplicate(docs: DataFrame, keep_text: bool = False, shard_bytes: int = SHARD_BYTES,
                shard_max: int = SHARD_MAX) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept (remaining bytes)]."""
    prepare(docs.sparkSession)
    spans = (repeated_windows(docs, shard_bytes, shard_max).groupBy("doc", "sign")
             .agg(F.collect_list("place").alias("places")).withColumnsRenamed({"doc": "__doc", "sign": "__sign"}))
    texts = _packed(_keyed(docs).select("doc_id", "doc", "sign", "body"))
    rows = (texts.join(spans, (F.col("doc") == F.col("__doc")) & (F.col("sign") == F.col("__sign")), "left")
            .select("doc_id", "body", "places"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return rows.mapInArrow(_erase(keep_text), schema + (", kept binary" if keep_text else ""))
