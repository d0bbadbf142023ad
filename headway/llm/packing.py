"""Packing token sequences into as few bins as possible by linear grouping.

Lengths are whole numbers up to the capacity, so everything the plan needs is the histogram of piece
lengths: at most ``capacity`` rows whatever the size of the corpus.  From it the driver

1. sorts the large lengths, cuts them into ``GROUPS`` groups of equal cardinality and rounds each up
   to its group's longest;
2. optimises the few-size problem: configurations are found by column generation (a small simplex
   whose pricing step is an unbounded knapsack), rounded down, and the rest placed first-fit;
3. substitutes the actual documents: slot r of a group takes its r-th longest piece, which frees the
   rounding slack again;
4. packs the small lengths, longest first, best-fit into what is left, opening bins only when none fits.

Steps 3 and 4 work on runs of equal bins, never on single ones, so the plan stays a few thousand
intervals ``(length, ranks) -> (bins, offset)``.  Spark numbers the pieces of each length (a counter
per task plus an offset per task and length: no shuffle of pieces) and looks every piece up.

Defined cases: null text is empty (one piece, the closing id 0); repeated rows are packed once each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm import tokens
from headway.llm.common import prepare, stored

TEXTS = 500            # texts that are encoded together
CAPACITY = 2048
GROUPS = 64
SMALL_PART = 8        # lengths up to capacity / SMALL_PART are small


# ---------------------------------------------------------------- few-size problem

def _knapsack(sizes: list[int], value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: best value and the counts of the best configuration."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    for i, s in enumerate(sizes):
        if value[i] <= 1e-12:
            continue
        for at in range(s, capacity + 1, s):
            hi = min(at + s, capacity + 1)
            with_i = best[at - s: hi - s] + value[i]
            up = with_i > best[at:hi] + 1e-12
            best[at:hi][up] = with_i[up]
            last[at:hi][up] = i
    counts = np.zeros(len(sizes))
    c = int(best.argmax())
    total = best[c]
    while c > 0:
        i = last[c]
        if i < 0:
            c -= 1
            continue
        # `last` is the last size that improved c; its remainder is optimal for c - size at that time or better
        counts[i] += 1
        c -= sizes[i]
    return total, counts


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 400) -> list[tuple[int, np.ndarray]]:
    """Whole numbers of bins per configuration that cover the demand of every size."""
    k = len(sizes)
    if not k:
        return []
    demand_v = np.array(demand, float)
    basis = np.diag([float(capacity // s) for s in sizes])
    for _ in range(rounds):
        inv = np.linalg.inv(basis)
        x = inv @ demand_v
        dual = np.ones(k) @ inv
        total, column = _knapsack(sizes, dual, capacity)
        if dual @ column <= 1 + 1e-9:
            break
        step = inv @ column
        ratio = np.where(step > 1e-12, x / np.where(step > 1e-12, step, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    x = np.maximum(np.linalg.solve(basis, demand_v), 0)
    plan = [(int(np.floor(n + 1e-9)), basis[:, j].astype(int)) for j, n in enumerate(x)]
    left = np.array(demand) - sum((n * c for n, c in plan), np.zeros(k, int))
    plan = [(n, c) for n, c in plan if n > 0]
    # the rest, a handful of items: first-fit from the longest
    open_bins: list[list] = []
    for i in sorted(range(k), key=lambda i: -sizes[i]):
        for _ in range(max(0, int(left[i]))):
            for b in open_bins:
                if b[0] >= sizes[i]:
                    break
            else:
                b = [capacity, np.zeros(k, int)]
                open_bins.append(b)
            b[0] -= sizes[i]
            b[1][i] += 1
    return plan + [(1, b[1]) for b in open_bins]


# ---------------------------------------------------------------- plan

def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, ranks, first bin, ranks per bin, offset) covering every rank, and the
    number of bins.  Rank r of a row goes to bin first_bin + (r - first) // per_bin."""
    rows: list[tuple[int, int, int, int, int, int]] = []
    bins = 0
    full = histogram.get(capacity, 0)
    if full:
        rows.append((capacity, 0, full, 0, 1, 0))
        bins = full
    small_max = capacity // SMALL_PART
    large = sorted((n for n in histogram if small_max < n < capacity), reverse=True)
    counts = np.array([histogram[n] for n in large], np.int64)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    start = ends - counts
    spare: dict[int, list[tuple[int, int, int]]] = defaultdict(list)   # room -> (first bin, bins, used)

    if total:
        cuts = sorted({total * g // groups for g in range(groups + 1)})
        lows, highs = cuts[:-1], cuts[1:]
        sizes = [large[int(np.searchsorted(ends, lo, "right"))] for lo in lows]
        cursor = dict(enumerate(lows))
        # groups that begin with the same length are one size
        by_size: dict[int, list[int]] = defaultdict(list)
        for g, s in enumerate(sizes):
            by_size[s].append(g)
        names = list(by_size)
        spans = {s: (lows[gs[0]], highs[gs[-1]]) for s, gs in by_size.items()}
        cursor = {s: spans[s][0] for s in names}
        for n, config in configurations(names, [spans[s][1] - spans[s][0] for s in names], capacity):
            slots = []                                   # (global rank of the slot in the first bin, bins filled)
            for i, s in enumerate(names):
                for _ in range(int(config[i])):
                    have = min(n, spans[s][1] - cursor[s])
                    if have > 0:
                        slots.append((cursor[s], have))
                        cursor[s] += have
            marks = {0, n}
            for r, have in slots:
                marks.add(have)
                a, b = np.searchsorted(ends, r, "right"), np.searchsorted(ends, r + have - 1, "right")
                marks.update(int(e) - r for e in ends[a:b])
            marks = sorted(m for m in marks if 0 <= m <= n)
            for lo, hi in zip(marks[:-1], marks[1:]):
                used = 0
                for r, have in slots:
                    if lo >= have:
                        continue
                    k = int(np.searchsorted(ends, r + lo, "right"))
                    rows.append((large[k], int(r + lo - start[k]), hi - lo, bins + lo, 1, used))
                    used += large[k]
                if used:
                    spare[capacity - used].append((bins + lo, hi - lo, used))
                elif hi > lo:
                    spare[capacity].append((bins + lo, hi - lo, 0))
            bins += n

    rooms = sorted(spare)

    def give(room: int, run: tuple[int, int, int]) -> None:
        if room > 0 and run[1] > 0:
            if not spare.get(room):
                insort(rooms, room)
                spare[room] = []
            spare[room].append(run)

    for length in sorted((n for n in histogram if n <= small_max), reverse=True):
        left, rank = histogram[length], 0
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                first, count, used = spare[room].pop()
                if not spare[room]:
                    del spare[room], rooms[i]
            else:
                room, used, first = capacity, 0, bins
                count = -(-left // (capacity // length))
                bins += count
            per = room // length
            whole = min(count, left // per)
            if whole:
                rows.append((length, rank, whole * per, first, per, used))
                rank, left = rank + whole * per, left - whole * per
                give(room - per * length, (first, whole, used + per * length))
            if whole < count and left:
                rows.append((length, rank, left, first + whole, left, used))
                give(room - left * length, (first + whole, 1, used + left * length))
                rank, left, whole = rank + left, 0, whole + 1
            if whole < count:
                give(room, (first + whole, count - whole, used))
    return np.array(rows, np.int64).reshape(-1, 6), bins


# ---------------------------------------------------------------- Spark jobs

def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], task, nth): whole texts as ids closed by id 0, cut
    at the capacity; ``nth`` numbers the pieces of one length within the task that made them."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, task = tokens.encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                b = whole.slice(at, TEXTS)
                flat, bound = enc.encode([t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()])
                size = np.diff(bound)
                cut = -(-size // capacity)
                doc = np.repeat(np.arange(len(size)), cut)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(cut) - cut, cut)
                start = piece * capacity
                length = np.minimum(size[doc] - start, capacity)
                order = np.argsort(length, kind="stable")
                run_len = length[order]
                first = np.flatnonzero(np.concatenate([[True], run_len[1:] != run_len[:-1]]))
                nth = np.empty(len(doc), np.int64)
                nth[order] = np.arange(len(doc)) - np.repeat(first, np.diff(np.concatenate([first, [len(doc)]])))
                nth += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                raw = flat.astype("<u4")
                lo = bound[doc] + start
                crc = [crc32(raw[a: a + n]) for a, n in zip(lo.tolist(), length.tolist())]
                cols = [b.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start),
                        pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), task, np.int32)),
                        pa.array(nth)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
                if with_ids:                             # pieces of one batch are contiguous in `flat`
                    cols.append(pa.ListArray.from_arrays(
                        pa.array(np.concatenate([lo, [len(flat)]]), pa.int32()), pa.array(flat)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _look_up(plan: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((plan[:, 1], plan[:, 0]))
    plan = plan[order]
    key = (plan[:, 0] << 48) | plan[:, 1]
    for b in batches:
        length, rank = (b.column(i).to_numpy() for i in (b.num_columns - 2, b.num_columns - 1))
        row = plan[np.searchsorted(key, (length << 48) | rank, "right") - 1]
        by = rank - row[:, 1]
        seq = row[:, 3] + by // row[:, 4]
        offset = row[:, 5] + by % row[:, 4] * length
        yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(seq), pa.array(offset)],
                                         names=[*b.schema.names[:-2], "sequence_id", "offset"])


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, groups: int = GROUPS,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]."""
    prepare(docs.sparkSession)
    cut = stored(pieces(docs, path or tokens.default_path(), capacity, with_ids), "pack-pieces")
    per_task = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = plan_bins(histogram, capacity, groups)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    ranked = cut.join(offsets, ["task", "length"]).select(
        *keep, F.col("length").alias("l"), (F.col("before") + F.col("nth")).alias("rank"))
    schema = ranked.select(*keep).schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(lambda it: _look_up(plan, it), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces with ids -> (sequence_id, ids): each sequence holds at most ``capacity`` ids."""
    part = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(part, lambda p: p["ids"])).alias("ids"))
