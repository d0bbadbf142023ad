"""SimHash near-dedup by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments (23 + 23 + 18 bits).  A segment, padded to 23 bits,
is decoded with the perfect binary Golay code [23, 12, 7]: its keys are the 12-bit indices of all
codewords within distance four (one if the nearest codeword is at distance two or less, else six).
Two segments that differ in at most two bits share such an index.  At most four differing bits over
three segments leave, by pigeonhole, one of two cases:

* some segment is equal and another differs in at most two bits: the key is (equal segment, index of
  the other), 35 bits, for the six ordered pairs of segments;
* no segment is equal, so the errors are 1, 1 and at most 2: the key is the three indices, 36 bits.

Equal fingerprints are collapsed first.  Keys are joined by one shuffle, candidates verified by
their exact bit distance, and each bucket emits a spanning star per class instead of its pairs.  A
bucket of more than ``BLOCK`` fingerprints is cut into blocks whose pairs are compared in separate
tasks, all of them, so no link is lost and no task holds the bucket.

Defined cases: null or blank text -> fingerprint zero, linked like any other; repeated rows are rows
of their own with equal fingerprints; a null doc_id is never a component's name unless the component
has nothing else; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import prepare, release_memos, rows_of, stored, unpack
from headway.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BLOCK = 4096          # fingerprints of one bucket compared by one task
SMALL = 16            # buckets up to this size are compared across buckets, by shifted rows
SEGMENTS = ((0, 23), (23, 23), (46, 18))   # (lowest bit, width)
GOLAY = 0xC75         # fixed value: generator polynomial of the binary Golay code


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one UTF-8 text."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:n - shingle].tolist()]
        stops = (ends[shingle - 1:] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at: at + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: list, shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns plus ``fp`` (the fingerprint as a signed long)."""
    part = docs.select(*keep, F.col("text").alias("__text"))
    schema = part.drop("__text").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memos()
        for b in batches:
            texts = b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps.view(np.int64))],
                                             names=[*b.schema.names[:-1], "fp"])

    return part.mapInArrow(run, schema)


# ---------------------------------------------------------------- Golay keys

@lru_cache(1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndrome tables of the low 12 and high 11 bits, error patterns of each syndrome (2048 x 6,
    the first of least weight) and their number (1 or 6)."""
    unit = np.empty(23, np.int64)
    for i in range(23):
        r = 1 << i
        for k in range(22, 10, -1):
            if r >> k & 1:
                r ^= GOLAY << (k - 11)
        unit[i] = r

    def syndromes(bits: int, first: int) -> np.ndarray:
        t = np.zeros(1 << bits, np.int64)
        for i in range(bits):
            t[1 << i: 2 << i] = t[: 1 << i] ^ unit[first + i]
        return t

    errors = np.zeros((2048, 6), np.int64)
    count = np.zeros(2048, np.int64)
    weight = np.full(2048, 9)
    for w in range(5):
        for bits in combinations(range(23), w):
            e, s = 0, 0
            for i in bits:
                e |= 1 << i
                s ^= int(unit[i])
            if weight[s] < 3 and w > weight[s]:
                continue                       # at distance 2 or less there is no other codeword within 4
            weight[s] = min(weight[s], w)
            errors[s, count[s]] = e
            count[s] += 1
    return syndromes(12, 0), syndromes(11, 12), errors, count


def segment_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Golay indices of 23-bit words: (rows, index) pairs, ordered by row."""
    low, high, errors, count = golay()
    syn = low[words & 4095] ^ high[words >> 12]
    n = count[syn]
    rows = np.repeat(np.arange(len(words)), n)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    return rows, (words[rows] ^ errors[syn[rows], nth]) >> 11


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (row, key) of unsigned fingerprints; the top bits of a key name its kind."""
    seg = [((fps >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    ids = [segment_keys(s) for s in seg]
    out_rows, out_keys = [], []
    for i in range(3):
        for j in range(3):
            if i != j:
                rows, idx = ids[j]
                out_rows.append(rows)
                out_keys.append(((1 + 3 * i + j) << 40) | (seg[i][rows] << 12) | idx)
    # the three indices together: cross product per fingerprint
    rows, key = ids[0]
    for k in (1, 2):
        r2, i2 = ids[k]
        n2 = np.bincount(r2, minlength=len(fps))
        first = np.cumsum(n2) - n2
        rep = n2[rows]
        at = np.arange(rep.sum()) - np.repeat(np.cumsum(rep) - rep, rep)
        src = np.repeat(rows, rep)
        key = (np.repeat(key, rep) << 12) | i2[first[src] + at]
        rows = src
    out_rows.append(rows)
    out_keys.append(key | (15 << 40))
    return np.concatenate(out_rows), np.concatenate(out_keys)


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        all_fps = b.column(0).to_numpy()
        for at in range(0, len(all_fps), 2000):
            fps = all_fps[at: at + 2000]
            rows, keys = fuzzy_keys(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows])], names=["key", "fp"])


# ---------------------------------------------------------------- buckets

def _classes(fps: np.ndarray, bits: int) -> np.ndarray:
    """Index of the first member of each fingerprint's class under distance <= bits (one bucket)."""
    u = fps.view(np.uint64)
    n = len(u)
    label = np.full(n, -1)
    for i in range(n):
        if label[i] >= 0:
            continue
        label[i] = i
        todo = np.array([i])
        while len(todo):                       # breadth first, whole frontier rows at once
            rest = np.flatnonzero(label < 0)
            if not len(rest):
                break
            hit = np.zeros(len(rest), bool)
            for f in todo:
                hit |= np.bitwise_count(u[rest] ^ u[f]) <= bits
            todo = rest[hit]
            label[todo] = i
    return label


def _bucket_links(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp) sorted by key -> links (a, b), and blocks of buckets that are too large."""
    names = ["a", "b", "key", "block", "fps"]

    def out(a, b, blocks=()):
        if len(a):
            pair = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], 1), axis=0)
            k = len(pair)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()),
                 pa.nulls(k, pa.binary())], names=names)
        if blocks:
            k = len(blocks)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array([x[0] for x in blocks], pa.int64()),
                 pa.array([x[1] for x in blocks], pa.int32()), pa.array([x[2] for x in blocks], pa.binary())],
                names=names)

    def closed(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links of whole buckets of at most BLOCK rows."""
        cut = np.flatnonzero(np.diff(keys)) + 1
        first = np.concatenate([[0], cut])
        size = np.diff(np.concatenate([first, [len(keys)]]))
        a, b = [], []
        per_row = np.repeat(size, size)
        few = np.flatnonzero((per_row <= SMALL) & (per_row > 1))
        if len(few):
            k, f = keys[few], fps[few].view(np.uint64)
            for s in range(1, SMALL):
                i = np.flatnonzero(k[:-s] == k[s:]) if len(k) > s else np.empty(0, int)
                if not len(i):
                    break
                near = i[np.bitwise_count(f[i] ^ f[i + s]) <= bits]
                a.append(f[near].view(np.int64))
                b.append(f[near + s].view(np.int64))
        for g in np.flatnonzero(size > SMALL):
            own = fps[first[g]: first[g] + size[g]]
            lab = _classes(own, bits)
            i = np.flatnonzero(lab != np.arange(len(own)))
            a.append(own[i])
            b.append(own[lab[i]])
        if not a:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(a), np.concatenate(b)

    keys, fps = np.empty(0, np.int64), np.empty(0, np.int64)
    open_key, open_blocks = None, 0            # a bucket that is being cut into blocks
    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        fps = np.concatenate([fps, batch.column(1).to_numpy()])
        if not len(keys):
            continue
        if open_key is not None:               # go on with the open bucket
            end = int(np.searchsorted(keys, open_key, "right"))
            while end >= BLOCK:
                yield from out((), (), [(open_key, open_blocks, fps[:BLOCK].tobytes())])
                open_blocks += 1
                keys, fps, end = keys[BLOCK:], fps[BLOCK:], end - BLOCK
            if end == len(keys):
                continue
            if end:
                yield from out((), (), [(open_key, open_blocks, fps[:end].tobytes())])
                keys, fps = keys[end:], fps[end:]
            open_key, open_blocks = None, 0
        last = int(np.searchsorted(keys, keys[-1], "left"))     # the last bucket may go on
        big = []
        cut = np.flatnonzero(np.diff(keys[:last])) + 1 if last else np.empty(0, int)
        first = np.concatenate([[0], cut]) if last else np.empty(0, int)
        size = np.diff(np.concatenate([first, [last]])) if last else np.empty(0, int)
        over = np.zeros(last, bool)
        for g in np.flatnonzero(size > BLOCK):
            over[first[g]: first[g] + size[g]] = True
            for n, at in enumerate(range(0, size[g], BLOCK)):
                part = fps[first[g] + at: first[g] + min(at + BLOCK, size[g])]
                big.append((int(keys[first[g]]), n, part.tobytes()))
        if last:
            yield from out(*closed(keys[:last][~over], fps[:last][~over]), big)
        keys, fps = keys[last:], fps[last:]
        if len(keys) > BLOCK:
            open_key, open_blocks = int(keys[0]), 0
            while len(keys) >= BLOCK:
                yield from out((), (), [(open_key, open_blocks, fps[:BLOCK].tobytes())])
                open_blocks += 1
                keys, fps = keys[BLOCK:], fps[BLOCK:]
    if open_key is not None:
        if len(keys):
            yield from out((), (), [(open_key, open_blocks, fps.tobytes())])
    elif len(keys):
        yield from out(*closed(keys, fps))


def _block_links(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks of one bucket: every link between them, as stars of their common classes."""
    for batch in batches:
        for x, y, same in zip(*(batch.column(i).to_pylist() for i in range(3))):
            u = np.frombuffer(x, np.int64)
            both = u if same else np.concatenate([u, np.frombuffer(y, np.int64)])
            lab = _classes(both, bits)
            i = np.flatnonzero(lab != np.arange(len(both)))
            yield pa.RecordBatch.from_arrays([pa.array(both[i]), pa.array(both[lab[i]])], names=["a", "b"])


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fps(fp)`` distinct -> ``(a, b)``: links that connect exactly the classes of distance <= max_bits."""
    if max_bits > MAX_BITS:
        raise ValueError("the key scheme covers at most four differing bits")
    keys = fps.select("fp").mapInArrow(_key_batches, "key long, fp long")
    in_buckets = keys.repartition("key").sortWithinPartitions("key")
    found = stored(in_buckets.mapInArrow(lambda it: _bucket_links(it, max_bits),
                                         "a long, b long, key long, block int, fps binary"), "simhash-links")
    blocks = found.where("block is not null")
    one = blocks.select("key", F.col("block").alias("i"), F.col("fps").alias("x"))
    two = blocks.select("key", F.col("block").alias("j"), F.col("fps").alias("y"))
    pairs = one.join(two, "key").where("i <= j").select("x", "y", (F.col("i") == F.col("j")).alias("same"))
    across = pairs.mapInArrow(lambda it: _block_links(it, max_bits), "a long, b long")
    return found.where("block is null").select("a", "b").union(across).distinct()


def components(fp_docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fp, who)`` rows -> ``(fp, first)``: the smallest ``who`` of the class of each fingerprint."""
    per = fp_docs.groupBy("fp").agg(F.min("who").alias("least"))
    per = stored(per, "simhash-fps")
    found = connected_components(links(per.select("fp"), max_bits), "simhash-cc")
    rooted = (per.join(found.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    low = rooted.groupBy("root").agg(F.min("least").alias("first"))
    return rooted.join(low, "root").select("fp", "first")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prepare(docs.sparkSession)
    fps = stored(fingerprints(docs, [F.col("doc_id")], shingle), "simhash-docs")
    named = components(fps.select("fp", F.col("doc_id").alias("who")), max_bits)
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents table with one document of each class: the one of smallest doc_id (null last),
    then of smallest text hash; of rows equal in both, one stays."""
    prepare(docs.sparkSession)
    sign = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    who = F.struct(F.col("doc_id").isNull().alias("z"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"),
                   sign.alias("sign"))
    fps = stored(fingerprints(docs, [who.alias("who")], shingle), "simhash-stage")
    keep = components(fps, max_bits).select("first").distinct()
    keep = keep.select(F.col("first.z").alias("__z"), F.col("first.id").alias("__id"),
                       F.col("first.sign").alias("__sign"))
    rows = docs.select(rows_of(docs), F.col("doc_id").isNull().alias("__z"),
                       F.coalesce(F.col("doc_id"), F.lit(0)).alias("__id"), sign.alias("__sign"))
    one = rows.join(keep, ["__z", "__id", "__sign"], "left_semi").dropDuplicates(["__z", "__id", "__sign"])
    return unpack(one, docs.columns)
