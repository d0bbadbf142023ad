"""Spelling variant grouping: words one edit apart, found by dynamic programming over sorted lists.

Words are counted over whole texts and pre-aggregated in every task.  One edit leaves the first half or the
last half of the longer word as it is, so a word joins a block of words with its first half, read forwards,
and a block with its last half, read backwards - once as the longer and once as the shorter of a pair.  Inside
a block the sorted list is scanned by the prefixes that neighbouring words share (their LCPs): the banded row
of the edit matrix (three cells: one edit) of a query and a shared prefix is computed once and carried on to all
words behind it, and a range of the list whose shared prefix is already more than one edit away is skipped.

Blocks lie in ranges of one global sort.  A block within a task is scanned there; blocks that cross a
range or exceed ``BLOCK_WORDS`` are cut into chunks, and chunks meet chunk by chunk (only those whose own shared prefixes can
still be within one edit), so that no task holds an unbounded block.  Nothing is capped.

Forms point from a word to its most frequent near word (twice as frequent at least); roots follow by pointer
doubling, a join per round, in at most log2 log2 of the largest count rounds.

Defined results: a null text has no words; a null doc_id counts as the text ``null`` in the digest that picks
letters to delete; repeated rows count again; ties go to the smaller word by code points; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import prepare, stored

LEAST_LENGTH, LEAST_COUNT, FACTOR = 5, 3, 2
DELETE_ONE_IN = 97
HELD_WORDS = 300_000        # distinct words that a task counts before it sends them on
BLOCK_WORDS = 4_096         # words of a block (or of a chunk of one) that are scanned as a list
SLICE_CELLS = 8_000_000     # words x length of a scan; queries are taken in slices of this many cells
_RUN = bytes(c if chr(c) in "abcdefghijklmnopqrstuvwxyz" or c >= 0xC0 else 0x20 for c in range(256))
BLOCK = "side int, longest int, block string, word string, n long"
FOUND = "word string, n_near long, best_n long, best string"
CHUNK = FOUND + ", side int, longest int, block string, shared string, words array<string>, ns array<long>"


# ---------------------------------------------------------------- words

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of letters of every text, some with a letter deleted, counted per task."""

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()),
                                           pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    total: Counter = Counter()
    for b in batches:
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            # one byte per code point: what is not in Latin-1 is no letter here, and becomes a mark
            runs = Counter((text or "").encode("latin-1", "replace").lower().translate(_RUN).split())
            start = crc32(f"{'null' if doc is None else doc}:".encode())
            for run, n in runs.items():
                length = len(run)
                if length < LEAST_LENGTH:
                    continue
                h = crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
                if h % DELETE_ONE_IN == 0:
                    at = h % length
                    run = run[:at] + run[at + 1:]
                    if length == LEAST_LENGTH:
                        continue
                total[run] += n
            if len(total) > HELD_WORDS:
                yield flush()
                total.clear()
    if total:
        yield flush()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word``, ``n``: what is counted, over all documents."""
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (texts.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


# ---------------------------------------------------------------- blocks

def _blocks(words: DataFrame) -> DataFrame:
    """Four rows per word: with its first half forwards, with its last half backwards, for pairs of which the
    longer word has its own length or one more.  ``block`` is the shared half, ``word`` as it is read."""
    length = F.length("word")
    sided = words.select("n", "word", F.explode(F.array(length, length + 1)).alias("longest"))
    sided = sided.withColumn("half", F.expr("int(longest div 2)"))     # ceil((longest - 1) / 2)
    forwards = sided.select(F.lit(0).alias("side"), "longest", F.expr("substr(word, 1, half)").alias("block"), "word", "n")
    back = F.reverse("word")
    backwards = sided.select(F.lit(1).alias("side"), "longest", "half", back.alias("word"), "n").select(
        "side", "longest", F.expr("substr(word, 1, longest - half)").alias("block"), "word", "n")
    return forwards.unionByName(backwards)


def _matrix(words: list[str], width: int, pad: int) -> np.ndarray:
    out = np.full((len(words), width), pad, np.uint16)
    for i, w in enumerate(words):
        out[i, :len(w)] = np.frombuffer(w.encode("utf-16-le"), np.uint16)
    return out


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows."""
    same = a == b
    return np.where(same.all(1), a.shape[1], (~same).argmax(1))


def scan(queries: list[str], lists: list[str], spans: np.ndarray, side: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, list entry) one edit apart of which the longer word has ``longest`` code points.

    ``lists`` holds sorted lists one after another; query i is looked up in ``spans[i]`` = (from, to), where every
    word shares its first half (side 1: words are read backwards, its last half) with the query.  A pair that shares both
    halves is found on side 0 alone.
    """
    half = longest // 2
    depth = half if side == 0 else longest - half
    width = longest + 2
    entry = _matrix(lists, longest + 1, 0)                  # 0: end of word, before every letter
    size = np.array([len(w) for w in lists])
    query = _matrix(queries, width, 0xFFFF)
    query_size = np.array([len(w) for w in queries])
    lcp = np.zeros(len(lists) + 1, np.int64)
    lcp[1:-1] = _common(entry[1:], entry[:-1])
    lcp[np.unique(spans)] = -1                              # lists end here: nothing is shared
    found: list[tuple[np.ndarray, np.ndarray]] = []
    per = max(1, SLICE_CELLS // (width * 16))
    nodes = {d: np.flatnonzero(lcp[:-1] < d) for d in range(depth, longest + 2)}     # where a prefix of d letters starts
    for a in range(0, len(queries), per):
        who = np.arange(a, min(a + per, len(queries)))
        who = who[spans[who, 0] < spans[who, 1]]
        low, high = spans[who, 0], spans[who, 1]
        # after the shared half the row is known: no edit, or one insertion or deletion
        row = np.tile(np.array([1, 0, 1], np.int8), (len(who), 1))
        for d in range(depth, longest + 1):
            # words that end here: the first entry of the range
            ends = size[low] == d
            off = query_size[who] - d
            hit = ends & (np.abs(off) <= 1)
            at = np.flatnonzero(hit)
            at = at[row[at, off[at] + 1] == 1]
            found.append((who[at], low[at]))
            if d == longest:
                break
            # the ranges one letter deeper, each with the row of its parent
            starts = nodes[d + 1]
            first, behind = np.searchsorted(starts, low), np.searchsorted(starts, high)
            n = behind - first
            parent = np.repeat(np.arange(len(who)), n)
            node = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(len(parent))
            new_low = starts[node]
            new_high = np.append(starts[1:], len(lists))[node]
            new_high = np.minimum(new_high, high[parent])
            grown = size[new_low] > d
            parent, new_low, new_high = parent[grown], new_low[grown], new_high[grown]
            if not len(parent):
                break
            who, old = who[parent], row[parent]
            letter = entry[new_low, d]
            end = query_size[who] - (d + 1)                  # cells right of the query's end do not exist
            row = np.empty_like(old)
            row[:, 0] = np.minimum(old[:, 0] + (query[who, d - 1] != letter), old[:, 1] + 1)
            row[:, 1] = np.minimum(np.minimum(old[:, 1] + (query[who, d] != letter), old[:, 2] + 1), row[:, 0] + 1)
            row[:, 2] = np.minimum(old[:, 2] + (query[who, d + 1] != letter), row[:, 1] + 1)
            for o in (-1, 0, 1):
                row[end < o, o + 1] = 2
            np.minimum(row, 2, out=row)
            near = row.min(1) <= 1                           # the others' ranges are skipped
            who, row, low, high = who[near], row[near], new_low[near], new_high[near]
    q = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
    e = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
    keep = np.maximum(query_size[q], size[e]) == longest
    q, e = q[keep], e[keep]
    if side == 1 and len(q):
        # read forwards: do they share the first half too?  letter i from the end is at length - 1 - i
        i = np.arange(half)
        both = (query[q[:, None], query_size[q][:, None] - 1 - i] == entry[e[:, None], size[e][:, None] - 1 - i]).all(1)
        q, e = q[~both], e[~both]
    return q, e


def _best(queries: list[str], lists: list[str], ns: np.ndarray, q: np.ndarray, e: np.ndarray, side: int) -> dict[str, list]:
    """Links -> per query word: number, count and word of the most frequent near word."""
    word = [w[::-1] for w in lists] if side else lists
    out: dict[int, list] = {}
    for i, j, n in zip(q.tolist(), e.tolist(), ns[e].tolist()):
        known = out.get(i)
        if known is None:
            out[i] = [1, n, word[j]]
            continue
        known[0] += 1
        if n > known[1] or n == known[1] and word[j] < known[2]:
            known[1:] = n, word[j]
    return {queries[i][::-1] if side else queries[i]: v for i, v in out.items()}


def _found(best: dict[str, list]) -> list[pa.Array]:
    return [pa.array(list(best), pa.string()), *[pa.array([v[k] for v in best.values()], kind)
                                                 for k, kind in ((0, pa.int64()), (1, pa.int64()), (2, pa.string()))]]


_SCHEMA = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string()),
                     ("side", pa.int32()), ("longest", pa.int32()), ("block", pa.string()), ("shared", pa.string()),
                     ("words", pa.list_(pa.string())), ("ns", pa.list_(pa.int64()))])


def _scan_ranges(most: int):
    """Sorted rows of one range -> links of the blocks that lie within, and chunks of the others."""

    def chunks(key: tuple, words: list[str], ns: list[int]) -> pa.RecordBatch:
        cuts = range(0, len(words), most)
        cols = [[None] * len(cuts)] * 4 + [[k] * len(cuts) for k in key] + [
            [commonprefix([words[i], words[min(i + most, len(words)) - 1]]) for i in cuts],
            [words[i:i + most] for i in cuts], [ns[i:i + most] for i in cuts]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SCHEMA)], schema=_SCHEMA)

    def links(side: int, longest: int, words: list[str], ns: list[int], spans: list[tuple]) -> Iterator[pa.RecordBatch]:
        each = np.repeat(np.array(spans, np.int64).reshape(-1, 2), [b - a for a, b in spans], axis=0)
        q, e = scan(words, words, each, side, longest)
        cols = _found(_best(words, words, np.array(ns, np.int64), q, e, side))
        if len(cols[0]):
            yield pa.RecordBatch.from_arrays([*cols, *[pa.nulls(len(cols[0]), f.type) for f in list(_SCHEMA)[4:]]],
                                             schema=_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, words, ns = None, [], []                # the open block
        kind, ready, ready_ns, spans = None, [], [], []      # closed blocks of one side and length
        first = True

        def close(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal first, words, ns, kind, ready, ready_ns, spans
            if kind != key[:2] or (len(ready) + len(words)) * key[1] > SLICE_CELLS // 16:
                if len(spans):
                    yield from links(*kind, ready, ready_ns, spans)
                kind, ready, ready_ns, spans = key[:2], [], [], []
            if words and (first or last or len(words) > most):
                yield chunks(key, words, ns)         # may go on in another range, or is too long a list
            elif len(words) > 1:
                spans.append((len(ready), len(ready) + len(words)))
                ready += words
                ready_ns += ns
            first, words, ns = False, [], []

        for b in batches:
            for *at, word, n in zip(*(c.to_pylist() for c in b.columns)):
                at = tuple(at)
                if at != key:
                    if key is not None:
                        yield from close(False)
                    key = at
                elif len(words) >= 2 * most:          # a long block is sent on as it comes
                    yield chunks(key, words[:most], ns[:most])
                    words, ns, first = words[most:], ns[most:], True
                words.append(word)
                ns.append(n)
        if key is not None:
            yield from close(True)
            if len(spans):
                yield from links(*kind, ready, ready_ns, spans)

    return run


def _scan_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk of queries and chunk of the same block's list -> links."""
    for b in batches:
        for side, longest, queries, lists, ns in zip(*(c.to_pylist() for c in b.columns)):
            spans = np.tile(np.array([[0, len(lists)]], np.int64), (len(queries), 1))
            q, e = scan(queries, lists, spans, side, longest)
            cols = _found(_best(queries, lists, np.array(ns, np.int64), q, e, side))
            if len(cols[0]):
                yield pa.RecordBatch.from_arrays(cols, names=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word``, ``n`` (distinct words) -> ``word, n_near, best_n, best`` for words with a near word."""
    keys = ["side", "longest", "block", "word"]
    rows = _blocks(words).repartitionByRange(*keys).sortWithinPartitions(*keys)
    scanned = stored(rows.mapInArrow(_scan_ranges(block_words), CHUNK), "spelling-blocks")
    whole = scanned.where("side is null").select("word", "n_near", "best_n", "best")
    cut = scanned.where("side is not null").select("side", "longest", "block", "shared", "words", "ns")
    x = cut.select("side", "longest", "block", F.col("shared").alias("p"), F.col("words").alias("queries"))
    y = cut.select("side", "longest", "block", F.col("shared").alias("q"), F.col("words").alias("lists"), "ns")
    # words one edit apart have prefixes of equal length that are at most two edits apart
    least = "least(length(p), length(q))"
    pairs = x.join(y, ["side", "longest", "block"]).where(
        F.expr(f"levenshtein(substr(p, 1, {least}), substr(q, 1, {least}), 2) >= 0"))
    crossed = pairs.select("side", "longest", "queries", "lists", "ns").mapInArrow(_scan_pairs, FOUND)
    at = F.struct((-F.col("best_n")).alias("m"), "best")
    return (whole.unionByName(crossed).groupBy("word")
            .agg(F.sum("n_near").alias("n_near"), F.min(at).alias("at"))
            .select("word", "n_near", (-F.col("at.m")).alias("best_n"), F.col("at.best").alias("best")))


# ---------------------------------------------------------------- forms and roots

def _roots(forms: DataFrame) -> DataFrame:
    """``word, form`` -> ``word, root``: the end of the chain of forms, by doubling."""
    step = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(step.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                           F.col("next").isNotNull().alias("went")), "spelling-roots")
        step = moved.select("word", "root")
        if not moved.where("went").limit(1).count():
            return step


def variants(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per word of the documents: form, root, n, n_near, form_n."""
    prepare(docs.sparkSession)
    words = stored(vocabulary(docs), "spelling-words")
    near = near_words(words, block_words)
    is_form = F.col("best_n") >= FACTOR * F.col("n")
    joined = stored(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = _roots(joined.where("form is not null"))
    return joined.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"),
                                                     "n", "n_near", "form_n")
