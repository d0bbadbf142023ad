"""Approximate nearest neighbours by balanced posting lists.

Vectors are reduced to distinct ones first: equal vectors have equal scores and ties go to the smaller
id, so the ``k + 1`` smallest ids of each distinct vector are all that any answer can name.  Largest
inner product becomes nearest distance by one added coordinate (the missing length to the longest
vector; queries get 0).

*Lists*: centroids are fitted by k-means on a bounded sample (a documented parameter), with a balance
term that moves centroids of small clusters into large ones.  A vector goes to its nearest centroid and is
replicated to other near ones while its distance stays within ``REPLICA`` times the nearest, so that
boundary vectors are found from either side.  *Search*: the centroids, held in memory, form a neighbour
graph; a query walks it best-first and visits the lists whose distance is within a ratio of its
nearest centroid's.  The ratio is measured on the sample: the one at which the lists hold ``RECALL`` of
the exact neighbours of ``PROBES`` sample vectors (neighbours within a sample are farther than among all
vectors, so the ratio errs to the safe side).  Scores are computed on the original vectors in double precision; no list is cut.

*Memory*: a query may visit most lists, so its vector is not copied for each.  Lists are dealt to *shelves*; a chunk of at most
``BLOCK_ROWS`` queries goes once to every shelf it visits, with a bit per query for each list.  A scoring task has
a *tile*, one shelf and one part of the queries (as many as ``HELD_BYTES`` hold): it keeps their vectors, the lists pass by in
blocks of ``BLOCK_ROWS`` vectors, and a score counts only if it reaches the query's ``k + 1``-th so far.  Whatever is made of a batch is
given out in pieces of ``PIECE_BYTES``.

Vectors of different lengths have no inner product: each length is a set with lists of its own, and a query
is answered among the vectors of its length.

Defined cases: vectors that are null, zero, empty or hold null or non-finite components take no part (as
queries either); a null vec_id takes no part; repeated rows of one
vec_id and vector count once; fewer than ``k`` other vectors: all are returned if their lists are visited;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import buffers, prepare, stored

K = 20
SAMPLE = 20_000        # vectors that the centroids are fitted on
LIST_ROWS = 400        # aimed at vectors per list
MAX_LISTS = 4096       # lists of the first level: centroids that every task holds
SPLIT_ROWS = 8 * LIST_ROWS  # first-level lists expected to be longer are split into lists of LIST_ROWS by an index of their own
SUB_SAMPLE = 16_000    # vectors of a long list that its index is fitted on, about
SUB_RECALL = 0.995     # as RECALL, for the index of a long list: two levels lose neighbours one after the other
SALTS = 16             # tasks that a long list's vectors are dealt in
REPLICA = 1.05
REPLICAS = 4           # lists of a vector at most; part of the index that the pruning ratio is measured with
RECALL = 0.97          # share of exact neighbours, within the sample, that the visited lists must hold
PROBES = 256           # queries of the sample on which the pruning ratio is set
BLOCK_ROWS = 512
HELD_BYTES = 32 << 20  # query vectors that a scoring task keeps, about; short ones count as QUERY_BYTES
QUERY_BYTES = 512
TILE_BYTES = 256 << 20  # vectors of a shelf, about
PIECE_BYTES = 8 << 20  # vectors given out at once
CELLS = 1 << 20        # distances computed at once
VISITS = 1 << 16       # visits of lists kept at once, about
HELD_TIMES = 3         # times the k + 1 best of a query that a scoring task keeps before it cuts them down
DEGREE = 24            # neighbours of a centroid in the graph
BEAM = 64              # candidates kept during a walk, at least


# ---------------------------------------------------------------- centroids

def fit_centroids(x: np.ndarray, lists: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Balanced k-means: after each round the centroids of the smallest clusters move next to those of
    the largest, if these hold more than twice the mean."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), lists, replace=False)].copy()
    for r in range(rounds):
        near = _nearest(x, c)
        size = np.bincount(near, minlength=lists)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], c)
        if r < rounds - 3:
            order = np.argsort(size)
            mean = len(x) / lists
            for small, large in zip(order, order[::-1]):
                if size[large] <= 2 * mean or size[small] >= mean / 2:
                    break
                own = x[near == large]
                c[small] = own[rng.integers(len(own))]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = 0.5 * (c * c).sum(axis=1)
    return np.concatenate([(half - x[a: a + 2048] @ c.T).argmin(axis=1) for a in range(0, len(x), 2048)])


class Lists:
    """Centroids with their neighbour graph."""

    def __init__(self, centroids: np.ndarray, longest: float):
        self.c = centroids
        self.longest = longest
        n = len(centroids)
        degree = min(DEGREE, n - 1)
        half = (centroids ** 2).sum(axis=1)
        near = np.zeros((n, degree), np.int64)
        step = max(1, CELLS // n)
        for a in range(0, n, step):
            d = half[None, :] - 2 * centroids[a: a + step] @ centroids.T
            d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
            near[a: a + step] = np.argsort(d, axis=1)[:, :degree]
        # a few long edges keep the graph connected for the walk
        rng = np.random.default_rng(5)
        ring = np.stack([(np.arange(n) + 1) % n, rng.permutation(n)], axis=1)
        self.graph = np.concatenate([near, ring], axis=1)
        self.start = int(((centroids - centroids.mean(axis=0)) ** 2).sum(axis=1).argmin())

    def lift(self, v: np.ndarray, query: bool) -> np.ndarray:
        """The added coordinate."""
        extra = np.zeros(len(v)) if query else np.sqrt(np.maximum(self.longest ** 2 - (v * v).sum(axis=1), 0))
        return np.concatenate([v, extra[:, None]], axis=1)

    def assign(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every vector: the nearest list and near ones at the boundary."""
        step = max(1, CELLS // len(self.c))
        pieces = [(a, *self._assign(v[a: a + step])) for a in range(0, len(v), step)]
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a + rows for a, rows, _ in pieces]), np.concatenate([at for _, _, at in pieces])

    def _assign(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.lift(v, False)
        d = np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ self.c.T + (self.c ** 2).sum(axis=1), 0))
        k = min(REPLICAS, d.shape[1])
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        dist = np.take_along_axis(d, near, 1)
        keep = dist <= REPLICA * dist.min(axis=1, keepdims=True)
        rows, cols = np.nonzero(keep)
        return rows, near[rows, cols]

    def calibrate(self, v: np.ndarray, recall: float = RECALL, k: int = K) -> float:
        """The distance ratio whose lists hold ``recall`` of the ``k`` nearest of some of the vectors."""
        rows, at = self.assign(v)
        q = self.lift(v[:PROBES], True)
        d = np.sqrt(np.maximum((q * q).sum(axis=1)[:, None] - 2 * q @ self.c.T + (self.c ** 2).sum(axis=1), 1e-18))
        ratio = d / d.min(axis=1, keepdims=True)
        near = v[:PROBES] @ v.T
        near[np.arange(len(q)), np.arange(len(q))] = -np.inf
        best = np.argsort(-near, axis=1)[:, :min(k, len(v) - 1)]
        first = np.searchsorted(rows, np.arange(len(v) + 1))
        need = [ratio[i, at[first[j]: first[j + 1]]].min() for i in range(len(q)) for j in best[i]]
        return float(np.quantile(need, recall, method="higher")) + 1e-9 if need else 1.0

    def visit(self, q: np.ndarray, prune: float) -> np.ndarray:
        """Lists within ``prune`` times the distance of the nearest, found by a best-first walk."""
        x = np.append(q, 0.0)
        dist = np.full(len(self.c), np.inf)
        done = np.zeros(len(self.c), bool)
        dist[self.start] = np.linalg.norm(self.c[self.start] - x)
        while True:
            best = dist.min()
            seen = np.flatnonzero((dist < np.inf) & ~done)
            if not len(seen):
                break
            known = dist[dist < np.inf]
            last = min(BEAM, len(known)) - 1
            limit = max(prune * best, np.partition(known, last)[last])
            todo = seen[dist[seen] <= limit]
            if not len(todo):
                break
            todo = todo[np.argsort(dist[todo])[:16]]
            done[todo] = True
            new = np.unique(self.graph[todo])
            new = new[dist[new] == np.inf]
            if len(new):
                dist[new] = np.linalg.norm(self.c[new] - x, axis=1)
        return np.flatnonzero(dist <= prune * dist.min())

    def visits(self, v: np.ndarray, prune: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, list) of every list that a query visits, in pieces."""
        rows, at, n = [], [], 0
        for i, x in enumerate(v):
            seen = self.visit(x, prune)
            rows.append(np.full(len(seen), i))
            at.append(seen)
            n += len(seen)
            if n >= VISITS or i == len(v) - 1:
                yield np.concatenate(rows), np.concatenate(at)
                rows, at, n = [], [], 0


# ---------------------------------------------------------------- Spark jobs

def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) with v as array<double>: only vectors that take part."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull())
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(finite & F.exists("v", lambda x: x != 0))


def _matrix(col: pa.Array) -> np.ndarray:
    n = len(col)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(float) if n else np.zeros((0, 0))


def _rows(lists: np.ndarray, ids: np.ndarray, v: np.ndarray, r: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(list, id, row) of the vectors ``v[r]``, in batches of about PIECE_BYTES."""
    size = 8 * v.shape[1]
    step = max(1, PIECE_BYTES // size)
    for a in range(0, len(r), step):
        at = r[a: a + step]
        data = np.ascontiguousarray(v[at], "<f8")
        offsets = np.arange(len(at) + 1, dtype=np.int32) * np.int32(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lists[a: a + step], pa.int64()), pa.array(ids[at], pa.int64()),
             pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])], names=["list", "id", "row"])


def build_lists(distinct: DataFrame, sample: int = SAMPLE, list_rows: int = LIST_ROWS, max_lists: int = MAX_LISTS) -> Lists | None:
    """Centroids fitted on the ``sample`` distinct vectors of smallest hash."""
    n, longest = distinct.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate(
        "v", F.lit(0.0), lambda a, x: a + x * x)))).first()
    if not n:
        return None
    at = F.xxhash64("least")
    few = -(1 << 63) + int((1 << 64) * min(1.0, (1.3 * sample + 1000) / n))       # most rows need not be sorted
    for some in ([distinct.where(at < few)] if few < 1 << 63 else []) + [distinct]:
        rows = some.orderBy(at, "least").limit(sample).select("v").toPandas()["v"]
        if len(rows) >= min(sample, n):
            break
    x = np.stack([np.asarray(v, float) for v in rows])
    lists = int(min(max_lists, max(1, round(n / list_rows)), max(1, len(x) // 4)))
    longest = longest * (1 + 1e-9)
    out = index_of(x, lists, longest)
    out.share = np.bincount(out.assign(x)[1], minlength=lists) / len(x) * n      # expected vectors per list
    return out


def index_of(x: np.ndarray, lists: int, longest: float, recall: float = RECALL, k: int = K) -> Lists:
    """An index with ``lists`` centroids over vectors like ``x``, and its pruning ratio."""
    lifted = np.concatenate([x, np.sqrt(np.maximum(longest ** 2 - (x * x).sum(axis=1), 0))[:, None]], axis=1)
    out = Lists(fit_centroids(lifted, lists), longest)
    out.prune = out.calibrate(x, recall, k)
    return out


def split_lists(dealt: DataFrame, big: dict[int, tuple[float, float]], list_rows: int, sub_sample: int = SUB_SAMPLE) -> DataFrame:
    """``(list, index)``: an index of its own for each of the long lists ``big`` (number -> expected vectors, longest
    vector), fitted in parallel on a bounded sample of the list's vectors."""
    import pandas as pd

    spark = dealt.sparkSession
    parts = 1 << 30
    wanted = spark.createDataFrame([(i, min(parts, int(parts * sub_sample / size))) for i, (size, _) in big.items()],
                                   "list long, below long")
    some = dealt.join(wanted, "list").where(F.pmod(F.xxhash64("id"), F.lit(parts)) < F.col("below")).select("list", "id", "row")

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        size, longest = big[int(key[0])]
        rows = rows.sort_values("id").drop_duplicates("id").iloc[:2 * sub_sample]
        x = np.stack([np.frombuffer(r, "<f8") for r in rows["row"]])
        lists = max(1, min(round(size / list_rows), len(x) // 4))
        near = max(1, round(K * len(x) / max(size, len(x))))          # so many of the k nearest are in the sample
        index = index_of(x, lists, longest, SUB_RECALL, near)
        return pd.DataFrame({"list": [key[0]], "index": [pickle.dumps(index)]})

    return stored(some.groupBy("list").applyInPandas(fit, "list long, index binary"), "ann-sub-lists")


def deal_again(dealt: DataFrame, indexes: DataFrame, kind: str) -> DataFrame:
    """Rows of long lists in the lists of their own index, numbered ``list * 2^32 + own number``; other rows as they are.

    A long list is dealt in ``SALTS`` tasks; each reads the index once, before its rows."""
    salted = dealt.select("list", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"), F.lit(None).cast("binary").alias("index"),
                          "id", "row")
    with_index = indexes.select("list", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "index",
                                F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("row"))
    both = salted.unionByName(with_index).repartition("list", "salt").sortWithinPartitions("list", "salt", F.col("index").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, index = None, None
        held: list[tuple[int, bytes]] = []

        def close() -> Iterator[pa.RecordBatch]:
            ids = np.array([i for i, _ in held], np.int64)
            v = np.stack([np.frombuffer(r, "<f8") for _, r in held])
            if index is None:
                pieces = [(np.arange(len(held)), np.zeros(len(held), np.int64))]
            elif kind == "rows":
                pieces = [index.assign(v)]
            else:
                pieces = index.visits(v, index.prune)
            for rows, own in pieces:
                yield from _rows((at[0] << 32) + own, ids, v, rows)

        for b in batches:
            for number, salt, raw, i, row in zip(*(c.to_pylist() for c in b.columns)):
                if held and ((number, salt) != at or len(held) >= 4096 or len(held) * len(row or b"") >= PIECE_BYTES):
                    yield from close()
                    held = []
                if (number, salt) != at:
                    at, index = (number, salt), None
                if raw is not None:
                    index = pickle.loads(raw)
                else:
                    held.append((i, row))
        if held:
            yield from close()

    return both.mapInArrow(run, "list long, id long, row binary")


# ---------------------------------------------------------------- tiles

TILE = "tile int, list long, kind int, id long, ids binary, m binary"
VECTORS, ASKED, LISTED = range(3)      # kinds of a tile's rows; vectors come first, then list by list who asks and what it holds


class Tiles:
    """Shelves of lists and parts of the queries; a tile is one of each."""

    def __init__(self, shelves: int, parts: int):
        self.shelves, self.parts = shelves, parts

    def shelf(self, lists):
        """Of list numbers, or of a column of them: numbers of split lists differ in the upper half too."""
        if isinstance(lists, Column):
            return F.pmod(lists + F.shiftright(lists, 32), F.lit(self.shelves))
        return (lists + (lists >> 32)) % self.shelves

    def chunk(self, ids: np.ndarray, v: np.ndarray, lists: np.ndarray, seen: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows of a chunk of queries: ``seen[i, j]`` says that the i-th visits ``lists[j]``.  Its first id names the chunk."""
        met = np.flatnonzero(seen.any(axis=0))
        bits = np.ascontiguousarray(np.packbits(seen[:, met], axis=0).T)
        lists = lists[met]
        shelf = self.shelf(lists)
        part = zlib.crc32(int(ids[0]).to_bytes(8, "little", signed=True)) % self.parts
        names, vectors = ids.astype("<i8").tobytes(), v.astype("<f8").tobytes()
        for s in np.unique(shelf).tolist():
            own = np.flatnonzero(shelf == s)
            n = len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([s * self.parts + part] * (n + 1), pa.int32()), pa.array([-1, *lists[own].tolist()], pa.int64()),
                 pa.array([VECTORS] + [ASKED] * n, pa.int32()), pa.array([int(ids[0])] * (n + 1), pa.int64()),
                 pa.array([names] + [b""] * n, pa.binary()), pa.array([vectors, *(bits[j].tobytes() for j in own)], pa.binary())],
                names=["tile", "list", "kind", "id", "ids", "m"])

    def gather(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(list, id, row) of queries, sorted by length and id -> rows of their chunks."""
        ids: list[int] = []
        rows: list[bytes] = []
        lists: list[list[int]] = []
        n = 0

        def close() -> Iterator[pa.RecordBatch]:
            met, at = np.unique(np.concatenate(lists), return_inverse=True)
            seen = np.zeros((len(ids), len(met)), bool)
            seen[np.repeat(np.arange(len(ids)), [len(x) for x in lists]), at] = True
            return self.chunk(np.array(ids, np.int64), np.stack([np.frombuffer(r, "<f8") for r in rows]), met, seen)

        for b in batches:
            for number, i, row in zip(*(c.to_pylist() for c in b.columns)):
                if ids and i != ids[-1] and (len(ids) >= BLOCK_ROWS or n >= VISITS or len(row) != len(rows[0])
                                             or len(ids) * len(row) >= PIECE_BYTES):
                    yield from close()
                    ids, rows, lists, n = [], [], [], 0
                if not ids or i != ids[-1]:
                    ids.append(i)
                    rows.append(row)
                    lists.append([])
                lists[-1].append(number)
                n += 1
        if ids:
            yield from close()


class Chunk:
    """Queries of a scoring task, and the ``k + 1`` best of each among the vectors shown so far."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, k: int):
        self.ids, self.v, self.k = ids, v, k
        self.length = np.sqrt((v * v).sum(1))
        self.reached = np.full(len(ids), -np.inf)      # a score that k + 1 of these reach
        self.held: list[tuple] = []
        self.rows = 0

    def show(self, which: np.ndarray, ids: np.ndarray, y: np.ndarray, longest: float) -> None:
        """Some vectors of a list that ``which`` of the queries visit."""
        top = min(self.k + 1, len(ids))
        s = (self.v if len(which) == len(self.ids) else self.v[which]) @ y.T
        reached = self.reached[which]
        slack = 1e-12 * self.length[which] * longest      # what sums of this size are rounded by: all ties count
        over = s >= (reached - slack)[:, None]
        many = np.flatnonzero(np.count_nonzero(over, axis=1) > top)
        if len(many):
            last = s.shape[1] - top
            cut = np.maximum(np.partition(s[many], last, axis=1)[:, last], reached[many])
            over[many] = s[many] >= (cut - slack[many])[:, None]
        q, at = np.nonzero(over)
        if len(q):
            self.held.append((which[q].astype(np.int32), ids[at], s[q, at]))
            self.rows += len(q)
            if self.rows > HELD_TIMES * (self.k + 1) * len(self.ids):
                self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Only the best stay: (query, least, near).  A vector met in several lists counts once."""
        q, at, near = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((-near, at, q))
        q, at, near = q[order], at[order], near[order]
        new = np.concatenate([[True], (q[1:] != q[:-1]) | (at[1:] != at[:-1])])
        q, at, near = q[new], at[new], near[new]
        order = np.lexsort((at, -near, q))
        q, at, near = q[order], at[order], near[order]
        first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        nth = np.arange(len(q)) - np.repeat(first, np.diff(np.concatenate([first, [len(q)]])))
        last = nth == self.k
        self.reached[q[last]] = near[last]
        keep = nth <= self.k
        best = q[keep], at[keep], near[keep]
        self.held, self.rows = [best], len(best[0])
        return best


def score_tiles(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows of tiles, sorted by tile, list and kind -> the best of every query in each tile."""
    tile, number = None, None
    chunks: dict[int, Chunk] = {}                        # of the tile
    asking: list[tuple[Chunk, np.ndarray]] = []          # who visits the list
    ids: list[np.ndarray] = []                           # a block of it
    blob: list[bytes] = []

    def show() -> None:
        n = sum(map(len, ids))
        if n and asking:
            own, y = np.concatenate(ids), np.frombuffer(b"".join(blob), "<f8").reshape(n, -1)
            longest = np.sqrt((y * y).sum(1).max())
            for chunk, which in asking:
                chunk.show(which, own, y, longest)
        ids.clear()
        blob.clear()

    def best() -> Iterator[pa.RecordBatch]:
        for chunk in chunks.values():
            if chunk.held:
                q, at, near = chunk.cut()
                yield pa.RecordBatch.from_arrays([pa.array(chunk.ids[q]), pa.array(at), pa.array(near)], names=["q", "least", "near"])
        chunks.clear()

    for b in batches:
        at = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(3)])
        name = b.column(3).to_numpy()
        raw, off = buffers(b.column(5))
        edge = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
        for a, e in zip([0, *edge.tolist()], [*edge.tolist(), b.num_rows]):
            now, where, kind = at[:, a].tolist()
            if (now, where) != (tile, number):
                show()
                asking = []
                if now != tile:
                    yield from best()
                tile, number = now, where
            if kind == VECTORS:
                for i in range(a, e):
                    own = np.frombuffer(b.column(4)[i].as_py(), "<i8")
                    chunks[int(name[i])] = Chunk(own, np.frombuffer(raw[off[i]: off[i + 1]].tobytes(), "<f8").reshape(len(own), -1), k)
            elif kind == ASKED:
                for i in range(a, e):
                    chunk = chunks[int(name[i])]
                    asking.append((chunk, np.flatnonzero(np.unpackbits(raw[off[i]: off[i + 1]], count=len(chunk.ids)))))
            else:
                while a < e:
                    z = min(e, a + BLOCK_ROWS - sum(map(len, ids)))
                    if asking:
                        ids.append(name[a: z])
                        blob.append(raw[off[a]: off[z]].tobytes())
                    a = z
                    if sum(map(len, ids)) >= BLOCK_ROWS:
                        show()
    show()
    yield from best()


def search(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
           prune: float | None = None, sample: int = SAMPLE, list_rows: int = LIST_ROWS, max_lists: int = MAX_LISTS,
           split_rows: int = SPLIT_ROWS, sub_sample: int = SUB_SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every query row, by inner product.
    ``prune`` is the distance ratio up to which lists are visited; measured on the sample if not given."""
    spark = prepare(vectors.sparkSession)
    rows = usable(vectors, id_col, vec_col).distinct()       # repeated rows are combined before the shuffle
    # distinct vectors with the k + 1 smallest ids: enough for any answer, ties go to the smaller id
    # (a vector with a third of all rows is one group, so ids are first cut down per salt)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    ranked = Window.partitionBy("v", "salt").orderBy("id")
    few = salted.withColumn("r", F.dense_rank().over(ranked)).where(F.col("r") <= k + 1)
    distinct = stored(few.groupBy("v").agg(
        F.slice(F.sort_array(F.collect_set("id")), 1, k + 1).alias("ids")).select(
        "v", "ids", F.element_at("ids", 1).alias("least")), "ann-vectors")
    widths = sorted(r[0] for r in distinct.select(F.size("v")).distinct().collect())     # a row per length
    if not widths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # every length's own lists and the number of its first one
    by_width: dict[int, tuple[Lists, int]] = {}
    used = 0
    for w in widths:
        own = build_lists(distinct.where(F.size("v") == w), sample, list_rows, max_lists)
        by_width[w] = own, used
        used += len(own.c)
    big = {first + i: (float(size), own.longest) for own, first in by_width.values()
           for i, size in enumerate(own.share.tolist()) if size > split_rows}
    wanted = vectors.where(is_query).select(F.col(id_col), F.col(vec_col))
    asked = usable(wanted, id_col, vec_col).distinct().withColumnRenamed("id", "query_id")
    # queries with one vector are asked once
    asked = stored(asked.join(distinct.select("v", F.col("least").alias("q")), "v").select("query_id", "q", "v", F.size("v").alias("w")),
                   "ann-queries")

    def by_length(b: pa.RecordBatch) -> Iterator[tuple[Lists, int, np.ndarray, np.ndarray]]:
        """The lists, the number of the first, ids and vectors of each length in a batch of (id, vector) rows."""
        width = pc.list_value_length(b.column(1)).to_numpy(zero_copy_only=False)
        for w in np.unique(width):
            mine = np.flatnonzero(width == w)
            step = max(1, PIECE_BYTES // (8 * int(w)))
            for a in range(0, len(mine), step):
                some = pa.array(mine[a: a + step])
                yield *by_width[int(w)], b.column(0).take(some).to_numpy(), _matrix(b.column(1).take(some))

    def deal(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
        """(list, id, vector) rows: a vector in every list it belongs to, a query in every list it visits."""
        for b in batches:
            for lists, first, ids, v in by_length(b):
                for r, at in [lists.assign(v)] if kind == "rows" else lists.visits(v, lists.prune if prune is None else prune):
                    yield from _rows(at + first, ids, v, r)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of chunks of queries."""
        for b in batches:
            for lists, first, ids, v in by_length(b):
                for a in range(0, len(v), BLOCK_ROWS):
                    some = v[a: a + BLOCK_ROWS]
                    seen = np.zeros((len(some), len(lists.c)), bool)
                    for r, at in lists.visits(some, lists.prune if prune is None else prune):
                        seen[r, at] = True
                    yield from tiles.chunk(ids[a: a + BLOCK_ROWS], some, np.arange(first, first + len(lists.c)), seen)

    def dealt(rows: DataFrame, kind: str) -> DataFrame:
        return rows.mapInArrow(lambda it: deal(it, kind), "list long, id long, row binary")

    # a part of the queries is held by a task, and meets all vectors: few parts; a shelf meets all queries: few shelves
    tasks = 4 * spark.sparkContext.defaultParallelism
    once = asked.repartition(tasks, "q").dropDuplicates(["q"]).select("q", "v")
    held = asked.select("q", "w").distinct().agg(F.sum(F.greatest(8 * F.col("w"), F.lit(QUERY_BYTES)))).first()[0] or 0
    parts = max(1, -(-held // HELD_BYTES))
    there = sum(8 * w * float(by_width[w][0].share.sum()) for w in widths)
    tiles = Tiles(min(used, max(-(-tasks // parts), int(there / TILE_BYTES) + 1)), parts)

    postings = dealt(distinct.select("least", "v"), "rows")
    if big:
        postings = stored(postings, "ann-postings")
        indexes = split_lists(postings, big, list_rows, sub_sample)
        postings = deal_again(postings, indexes, "rows")
        questions = deal_again(dealt(once, "queries"), indexes, "queries")
        questions = questions.repartition("id").sortWithinPartitions(F.length("row"), "id").mapInArrow(tiles.gather, TILE)
    else:
        questions = once.mapInArrow(ask, TILE)
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    shelved = postings.select("list", "id", "row", every.alias("part")).select(
        (tiles.shelf(F.col("list")) * parts + F.col("part")).cast("int").alias("tile"), "list", F.lit(LISTED).alias("kind"), "id",
        F.lit(b"").alias("ids"), F.col("row").alias("m"))
    both = questions.unionByName(shelved).repartitionById(tiles.shelves * parts, "tile").sortWithinPartitions("tile", "list", "kind")
    pairs = both.mapInArrow(lambda it: score_tiles(it, k), "q long, least long, near double")
    best = Window.partitionBy("q").orderBy(F.desc("near"), "least")
    found = (pairs.groupBy("q", "least").agg(F.max("near").alias("near"))
             .withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r", "near"))
    found = stored(found, "ann-found")
    # exact scores on the original vectors, then every query's own ids out of the candidates
    exact = F.aggregate(F.zip_with("v", "u", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    named = (found.join(distinct.select(F.col("least").alias("q"), F.col("v").alias("u")), "q")
             .join(distinct, "least").select("q", exact.alias("score"), F.explode("ids").alias("vec_id")))
    nearest = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    listed = stored(named.withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= k + 1)
                    .groupBy("q").agg(F.collect_list(F.struct("score", "vec_id")).alias("near")), "ann-named")
    each = (asked.select("query_id", "q").join(listed, "q")
            .select("query_id", F.explode("near").alias("n"))
            .select("query_id", F.col("n.score").alias("score"), F.col("n.vec_id").alias("vec_id"))
            .where("vec_id != query_id"))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (each.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def neighbour_report(vectors: DataFrame) -> DataFrame:
    return search(vectors, F.col("vec_id") % 20 == 0)
