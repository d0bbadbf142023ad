from __future__ import annotations

import os

import brute
import corpus_pipeline
import duckdb
import numpy as np
import pytest
from headway.llm import neighbours, oracle_sql, preferences, queries
from headway.llm.oracle import PREFERENCE_SQL
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- preferences

def test_preferences_by_hand(spark):
    turns = [(0, True, 0, "user", "hi"), (0, True, 1, "assistant", "yes"), (0, True, 2, "user", "more"),
             (0, False, 0, "user", "hi"), (0, False, 1, "assistant", "no"), (0, False, 0, "user", "hi"),
             (1, True, 0, "user", "only"), (None, True, 0, "user", "x"), (2, True, 0, None, None), (2, False, 0, "", "")]
    df = spark.createDataFrame(turns, "pair_id long, chosen boolean, turn long, role string, text string") \
        .withColumn("start", F.lit("clash")).withColumn("part", F.lit(1))
    rows = preferences.format_pairs(df)
    got = sorted((r.pair_id, r.part, r.turn, r.start, r.trained) for r in rows.collect())
    one = len("<|user|>\nhi<|end|>\n")
    assert got == [(0, "chosen", 1, 0, True), (0, "chosen", 2, len("<|assistant|>\nyes<|end|>\n"), False), (0, "prompt", 0, 0, False),
                   (0, "rejected", 1, 0, True), (1, "chosen", 0, 0, False), (2, "prompt", 0, 0, False)]
    whole = {r.pair_id: r for r in preferences.assemble(rows).collect()}
    assert whole[0].prompt == "<|user|>\nhi<|end|>\n" and len(whole[0].prompt) == one
    assert whole[0].chosen == "<|assistant|>\nyes<|end|>\n<|user|>\nmore<|end|>\n"
    assert [tuple(x) for x in whole[0].chosen_trained] == [(0, len("<|assistant|>\nyes<|end|>\n"))]
    assert preferences.format_pairs(df.limit(0)).count() == 0


def test_preferences_long_conversation_offsets(spark, monkeypatch):
    monkeypatch.setattr(preferences, "RANGE", 4)
    turns = [(0, c, t, "user" if t % 2 == 0 else "assistant", f"t{t}" + ("" if t < 30 else str(c))) for c in (True, False) for t in range(60)]
    rows = preferences.format_pairs(spark.createDataFrame(turns, "pair_id long, chosen boolean, turn long, role string, text string")).collect()
    for part, n in (("prompt", 30), ("chosen", 30), ("rejected", 30)):
        at = 0
        mine = sorted((r for r in rows if r.part == part), key=lambda r: r.turn)
        assert len(mine) == n
        for r in mine:
            assert r.start == at and r.length == len(r.rendered)
            at += r.length


def test_preferences_equal_sql(spark):
    df = queries()["op5_preferences"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    cur = con.execute(PREFERENCE_SQL)
    names = [c[0] for c in cur.description]
    assert sorted(tuple(r) for r in df.select(*names).collect()) == sorted(cur.fetchall())


# ---------------------------------------------------------------- neighbours

def _exact(ids, x, i, k=20):
    s = x @ x[i]
    s[i] = -np.inf
    return [(int(ids[j]), s[j]) for j in np.lexsort((ids, -s))[:k]]


def test_neighbours_recall_and_scores(spark):
    d = "/root/testdata/sf0.1"
    rows = queries()["op6_neighbours"](spark, d).collect()
    t = spark.read.parquet(f"{d}/embeddings.parquet").toPandas()
    ids, x = t.vec_id.to_numpy(), np.stack(t.embedding).astype(float)
    found = {}
    for r in rows:
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hit = 0
    at = {v: i for i, v in enumerate(ids.tolist())}
    for q, near in found.items():
        assert sorted(near) == list(range(1, 21))
        got = [near[k] for k in range(1, 21)]
        assert got == sorted(got, key=lambda p: (-p[1], p[0])) and q not in {v for v, _ in got}
        assert all(abs(s - float(x[at[q]] @ x[at[v]])) < 1e-12 for v, s in got)
        hit += len({v for v, _ in got} & {v for v, _ in _exact(ids, x, at[q])})
    assert set(found) == {int(i) for i in ids if i % 20 == 0} and hit / (20 * len(found)) >= 0.9


def test_neighbours_odd_rows(spark):
    rng = np.random.default_rng(2)
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(200)] + [(200 + i, rng.normal(size=3).tolist()) for i in range(100)]
    rows += [(400, None), (420, [0.0, 0.0, 0.0]), (440, [1.0, float("nan"), 0.0]), (460, [1.0, None, 2.0]),
             (480, [float("inf"), 0.0, 0.0]), (500, [1.0]), (None, same), (40, same)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("ids", F.lit("x"))
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in range(0, 300, 20)}
    near = [v for _, v, _ in sorted(got[40])]
    assert len(near) == 20 and 40 not in near
    hot = [v for v in near if v < 200]
    assert hot == sorted(hot) and hot == [i for i in range(200) if i != 40][:len(hot)]
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0])], "vec_id long, embedding array<float>")
    few = sorted(tuple(r) for r in neighbours.search(few, F.col("vec_id") % 20 == 0, prune=100.0).collect())
    assert few == [(0, 1, 1, 0.5), (0, 2, 20, 0.0), (20, 1, 1, 0.5), (20, 2, 0, 0.0)]
    assert neighbours.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def _clustered(n, seed=4, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, dim)) * 2
    return centres[rng.integers(0, 40, n)] + rng.normal(size=(n, dim))


def test_neighbours_in_lists_of_lists(spark):
    """Few first-level lists: long ones are split by indexes of their own, and recall holds."""
    v = _clustered(6000)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 60 == 0, sample=2000, list_rows=60, max_lists=8, split_rows=200,
                               sub_sample=600).collect():
        assert r.score == pytest.approx(float(v[r.query_id] @ v[r.vec_id]), abs=1e-9)
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 6000, 60):
        s = v @ v[q]
        s[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-s)[:20].tolist()))
    assert len(got) == 100 and hits / 2000 >= 0.95


def test_lists_keep_their_length_with_four_times_the_vectors(spark):
    """With the number of first-level lists held at eight, lists stay short and a query is scored against a part of what the
    first level alone would give it."""
    def measured(n):
        v = _clustered(n)
        df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "least long, v array<double>")
        own = neighbours.build_lists(df, sample=2000, list_rows=60, max_lists=8)
        rows, at = own.assign(v)
        asked = np.arange(0, n, n // 50)
        seen = [own.visit(x, own.prune) for x in v[asked]]
        frame = lambda lists, ids: spark.createDataFrame(
            [(int(x), int(i), v[i].astype("<f8").tobytes()) for x, i in zip(lists, ids)], "list long, id long, row binary")
        postings = frame(at, rows)
        questions = frame(np.concatenate(seen), np.repeat(asked, [len(x) for x in seen]))
        big = {i: (float(s), own.longest) for i, s in enumerate(own.share) if s > 200}
        assert len(big) >= 4
        index = neighbours.split_lists(postings, big, 60, 600)
        p, q = (neighbours.deal_again(x, index, k).groupBy("list").count() for x, k in ((postings, "rows"), (questions, "queries")))
        sizes = {r["list"]: r["count"] for r in p.collect()}
        alone = np.bincount(at, minlength=8)
        return (np.mean(list(sizes.values())), sum(r["count"] * sizes.get(r["list"], 0) for r in q.collect()) / len(asked),
                sum(alone[x].sum() for x in seen) / len(asked))

    for n in (4000, 16000):
        length, both, first = measured(n)
        assert length < 150 and both < 0.7 * first


@pytest.mark.parametrize("parts", [1, 8])
def test_neighbours_of_queries_that_visit_every_list(spark, monkeypatch, parts):
    """2000 queries that visit all 500 lists: their vectors are not copied for each, no worker gives out more than some MB at
    once, and what it gives out in all is a part of a row per visit."""
    most, limit = spark.sparkContext.accumulator(0), 12 << 20
    frame = type(spark.range(0))
    plain = frame.mapInArrow

    def noted(self, func, schema, *args, **kwargs):
        def run(batches):
            for b in func(batches):
                most.add(b.nbytes)
                if b.nbytes > limit:
                    raise ValueError(f"{b.nbytes} bytes in a batch of {b.num_rows} rows")
                yield b
        return plain(self, run, schema, *args, **kwargs)

    monkeypatch.setattr(frame, "mapInArrow", noted)
    if parts > 1:
        monkeypatch.setattr(neighbours, "HELD_BYTES", 2000 * 512 // parts)
    v = np.random.default_rng(6).normal(size=(2000, 16))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").coalesce(1)
    got = {}
    for r in neighbours.search(df, F.lit(True), prune=100.0, list_rows=4).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    assert set(got) == set(range(2000)) and most.value < 2000 * 500 * 16 * 8 / 2
    for q in range(0, 2000, 40):
        assert [got[q][k] for k in range(1, 21)] == [i for i, _ in _exact(np.arange(2000), v, q)]


def test_pieces_of_visits_and_lists_are_bounded():
    """What is made of one batch: distances, visits and rows in pieces, the same as at once."""
    v = np.random.default_rng(7).normal(size=(3000, 8))
    index = neighbours.index_of(v[:1000], 250, float(np.sqrt((v * v).sum(1).max())))
    whole = [index.visit(x, 100.0) for x in v]
    pieces = list(index.visits(v, 100.0))
    assert max(len(r) for r, _ in pieces) < neighbours.VISITS + 250 and len(pieces) > 10
    assert np.array_equal(np.concatenate([at for _, at in pieces]), np.concatenate(whole))
    assert np.array_equal(np.concatenate([r for r, _ in pieces]), np.repeat(np.arange(3000), [len(x) for x in whole]))
    at_once, by_piece = index._assign(v), index.assign(v)
    assert all(np.array_equal(a, b) for a, b in zip(at_once, by_piece))
    r, at = np.repeat(np.arange(3000), 100), np.tile(np.arange(100), 3000)
    batches = list(neighbours._rows(at, np.arange(3000), v, r))
    assert max(b.nbytes for b in batches) < 2 * neighbours.PIECE_BYTES and sum(b.num_rows for b in batches) == 300_000
    assert np.array_equal(np.frombuffer(batches[0].column(2)[150].as_py(), "<f8"), v[1])


def test_neighbours_hot_row_and_ties_of_large_vectors(spark):
    """A third of all rows are one row; equal scores of vectors of large norm go to the smaller id."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 6)) * 1e8
    rows = [(i, base[i % 60].tolist()) for i in range(300)] + [(20, base[20].tolist())] * 3000
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0, prune=100.0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    v = np.stack([base[i % 60] for i in range(300)])
    for q, near in got.items():
        s = {i: sum(a * b for a, b in zip(v[q].tolist(), v[i].tolist())) for i in range(300) if i != q}
        want = sorted(s, key=lambda i: (-s[i], i))[:20]
        assert [i for _, i in sorted(near)] == want


def test_neighbours_of_every_vector_length(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5 if i % 3 == 0 else 8).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0, prune=100.0).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    for n in (5, 8):
        ids = np.array([i for i, v in rows if len(v) == n])
        x = np.array([v for _, v in rows if len(v) == n])
        for q in ids[ids % 20 == 0].tolist():
            want = [v for v, _ in _exact(ids, x, int(np.flatnonzero(ids == q)[0]))]
            assert [got[q][k] for k in range(1, 21)] == want
    assert set(got) == set(range(0, 300, 20))


# ---------------------------------------------------------------- registration and pipeline

def test_every_operator_is_registered():
    names = list(queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(oracle_sql()) <= set(names)


def test_pipeline_stages(spark, small):
    """Each stage against the brute-force versions, on its own input."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    by = {r.doc_id: r.text for r in docs.collect()}
    (_, quality), (_, dedup), (_, mask), (_, mix), (_, pack) = corpus_pipeline.STAGES
    one = quality(spark, docs, small)
    assert one.columns == columns
    kept = {r.doc_id: r.text for r in one.collect()}
    assert kept.items() <= by.items()
    for i, t in by.items():
        words, _, _, _, repeat = brute.rule_measures(t)
        assert i not in kept or (words >= 50 and 100 * repeat <= 50 * words)
    two = dedup(spark, one, small)
    fps = {i: brute.simhash(t) for i, t in kept.items()}
    names = brute.classes(list(fps), list(fps.values()))
    survivors = {r.doc_id: r.text for r in two.collect()}
    assert two.columns == columns and set(survivors) == {names[f] for f in fps.values()} and survivors.items() <= kept.items()
    three = mask(spark, two, small)
    clean = {r.doc_id: r.text for r in three.collect()}
    assert three.columns == columns and set(clean) == set(survivors)
    assert not any(brute.pii_base(t) for t in clean.values())
    assert all(clean[i] == t for i, t in survivors.items() if not brute.pii_base(t))
    four = mix(spark, three, small).collect()
    assert all(clean[r.doc_id] == r.text for r in four) and max(np.bincount([r.doc_id for r in four])) <= 2
    words = sum(len(t.split()) for t in clean.values())
    assert 1.5 * words - 3 * max(len(t.split()) for t in clean.values()) <= sum(len(r.text.split()) for r in four) <= 1.5 * words
    five = pack(spark, mix(spark, three, small), small).collect()
    sizes = {}
    for r in five:
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
    assert max(sizes.values()) <= 2048 and {r.doc_id for r in five} == {r.doc_id for r in four}
    assert corpus_pipeline.run(spark, small).count() == len(five)


def test_pipeline_odd_and_empty_tables(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "")
            assert docs.columns == odd_documents.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= 0


@pytest.mark.parametrize("word", ["localCheckpoint", "tempfile", "except ImportError"])
def test_operators_do_not_use(word):
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    files = [os.path.join(root, "corpus_pipeline.py"), *(os.path.join(root, "headway", "llm", f) for f in os.listdir(
        os.path.join(root, "headway", "llm")) if f.endswith(".py"))]
    assert not [f for f in files if word in open(f).read()]


def test_pairs_of_large_conversation_ids(spark):
    """Ids beyond 2^53, where doubles have no odd numbers, and negative ones."""
    from headway.llm import preferences

    rows = [(c, 0, "user", f"hi {c}") for c in (2**53 + 2, 2**53 + 3, 2**62 + 1, -1, -2, -3, 0, 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {r.text: (r.pair_id, r.chosen) for r in preferences.neighbours_as_pairs(df).collect()}
    assert got == {f"hi {c}": (c // 2, c % 2 == 0) for c, *_ in rows}
