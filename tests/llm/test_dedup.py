from __future__ import annotations

import random
from itertools import combinations

import brute
import numpy as np
from headway.llm import simhash, substrings, suffix_array
from headway.llm.components import connected_components
from headway.llm.queries import queries
from pyspark.sql import functions as F


def test_golay_segments_share_a_key_within_two_bits():
    """Exhaustive over cosets: every 23-bit word is a codeword plus a coset leader."""
    _, _, errors, count = simhash.golay()
    assert sorted(set(count.tolist())) == [1, 6]
    words = errors[:, 0]
    keys = [set() for _ in words]
    for r, k in zip(*simhash.segment_keys(words)):
        keys[r].add(int(k))
    flips = [1 << i for i in range(23)] + [1 << i | 1 << j for i, j in combinations(range(23), 2)]
    for f in flips:
        rows, idx = simhash.segment_keys(words ^ f)
        hit = np.zeros(len(words), bool)
        for r, k in zip(rows.tolist(), idx.tolist()):
            hit[r] |= k in keys[r]
        assert hit.all()


def test_fuzzy_keys_reach_every_pair_within_four_bits():
    rng = random.Random(4)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << bit
        rows, keys = simhash.fuzzy_keys(np.array([a, b], np.uint64))
        assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())


def test_fingerprint_is_the_contract():
    rng = random.Random(1)
    for n in (0, 1, 3, 4, 5, 40):
        text = " \t".join(rng.choice(["Ab", "c", "ÉÀ", "d.", "Zz9"]) for _ in range(n))
        assert simhash.fingerprint(text.encode()) == brute.simhash(text)


def test_components_of_stars_chains_and_hot_nodes(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(5, 5), (None, 3), (300, 200)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 160)) and got[300] == 200
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_equals_brute_force(spark, small):
    rows = queries()["op9_simhash"](spark, small).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    fps = {i: brute.simhash(t) for i, t in docs.items()}
    names = brute.classes(list(fps), list(fps.values()))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{f:016x}", names[f]) for i, f in fps.items()}


def test_large_buckets_in_blocks_lose_no_link(spark, monkeypatch):
    """Blocks of a few fingerprints give the same classes as whole buckets."""
    rng = random.Random(9)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            x = centre
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps)
    want = brute.classes(fps, fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    for block, small in ((4096, 16), (8, 4)):
        monkeypatch.setattr(simhash, "BLOCK", block)
        monkeypatch.setattr(simhash, "SMALL", small)
        keys = df.mapInArrow(simhash._key_batches, "key long, fp long").toArrow().sort_by("key").combine_chunks()
        batches = keys.to_batches(max_chunksize=50)
        pairs, blocks = [], {}
        for b in simhash._bucket_links(iter(batches), 4):
            for r in b.to_pylist():
                if r["key"] is None:
                    pairs.append((r["a"], r["b"]))
                else:
                    blocks.setdefault(r["key"], []).append(r["fps"])
        import pyarrow as pa

        for parts in blocks.values():
            for i, x in enumerate(parts):
                for j in range(i, len(parts)):
                    one = pa.RecordBatch.from_arrays([pa.array([x]), pa.array([parts[j]]), pa.array([i == j])],
                                                     names=["x", "y", "same"])
                    for b in simhash._block_links(iter([one]), 4):
                        pairs += [(r["a"], r["b"]) for r in b.to_pylist()]
        parent = {f: f for f in (int(np.uint64(f).astype(np.int64)) for f in fps)}

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[find(a)] = find(b)
        groups = {}
        for f in fps:
            groups.setdefault(find(int(np.uint64(f).astype(np.int64))), set()).add(f)
        wanted = {}
        for f in fps:
            wanted.setdefault(want[f], set()).add(f)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))
        assert (block == 4096) != bool(blocks)


def test_simhash_odd_rows(spark, odd_documents, no_documents):
    rows = simhash.simhash_components(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert by[3] == by[4] == by[5] == {("0" * 16, 3)}
    assert by[1] == {(f"{brute.simhash(odd_documents.where('doc_id = 1').first().text):016x}", 1)}
    kept = simhash.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 3 in ids and 4 not in ids and 5 not in ids
    assert simhash.simhash_components(no_documents).count() == 0 and simhash.keep_one(no_documents).count() == 0


def test_suffix_array_and_prefixes():
    rng = random.Random(3)
    for _ in range(60):
        alphabet = rng.choice([b"ab", b"abc", bytes(range(97, 110)), b"a"])
        strings = [bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 9))]
        strings += strings[:2]
        s, starts = suffix_array.join(strings)
        sa = suffix_array.suffix_array(s)
        want = sorted((x[i:], k, i) for k, x in enumerate(strings) for i in range(len(x)))
        pos = [p for p in sa.tolist() if s[p] > 2]
        which = np.searchsorted(starts, pos, "right") - 1
        assert [(strings[k][p - starts[k]:], int(k), int(p - starts[k])) for p, k in zip(pos, which)] == want
        prefixes = suffix_array.common_prefixes(s, sa)[len(s) - len(pos):]
        for (a, _, _), (b, _, _), n in zip(want, want[1:], prefixes[1:]):
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert n == same


def _check_substrings(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.deduplicate(df, **options).collect()}
    assert got == brute.substrings([(i, (t or "").encode()) for i, t in rows])


def test_substrings_equal_brute_force(spark, small):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.choice([5, 99, 100, 101, 150, 400])))) for i in range(20)]
    rows += [(50 + i, "a" * n) for i, n in enumerate((50, 100, 101, 300, 900))]
    rows += [(70, "xy" * 200), (71, "xyz" * 150), (72, "xy" * 60), (80, None), (81, ""), (82, "ñé" * 80)]
    base = "".join(rng.choice("abcdef ") for _ in range(500))
    rows += [(90 + i, base[i * 7: i * 7 + 300] + str(i)) for i in range(20)]
    _check_substrings(spark, rows)
    _check_substrings(spark, rows, shard_bytes=300, shard_max=400)      # hot anchors by window digests
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in queries()["op2_substrings"](spark, small).collect()}
    assert got == brute.substrings([(r.doc_id, (r.text or "").encode()) for r in docs])


def test_substrings_long_text_in_segments(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SEGMENT", 1500)
    rng = random.Random(8)
    base = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    col = __import__("pyarrow").array([base, base[500:2500], "q" + base[1000:3000], "x"])
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array([0, 0, 0, 0]), col.cast(pa.binary())],
                                       names=["doc", "sign", "body"])
    seen = {}
    for b in substrings._chunk_rows(iter([batch])):
        for r in b.to_pylist():
            n = r["place"] & 127
            start = r["place"] >> 7 & (1 << 32) - 1
            for p in range(start, start + n):
                seen[r["doc"], p] = seen.get((r["doc"], p), 0) + 1
    want = {(d, p) for d, t in ((1, 4000), (2, 2000), (3, 2001)) for p in range(t - 99)}
    assert set(seen) == want and set(seen.values()) == {1}              # every window in exactly one chunk


def test_substrings_odd_rows(spark, odd_documents, no_documents):
    rows = substrings.deduplicate(odd_documents, keep_text=True).collect()
    assert len(rows) == odd_documents.count()
    ones = [r for r in rows if r.doc_id == 1]
    assert len(ones) == 2 and ones[0] == ones[1]
    (two,) = [r for r in rows if r.doc_id == 2]
    assert two.n_removed > 0 and bytes(two.kept).endswith(b"end")
    assert [r.n_bytes for r in rows if r.doc_id in (3, 4)] == [0, 0]
    assert substrings.deduplicate(no_documents).count() == 0


def test_substrings_of_one_doc_id_are_told_apart_by_the_whole_hash(spark):
    """Two texts without a doc_id whose hashes share the low 24 bits: each loses its own repeats only."""
    words = F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.md5(F.concat_ws("-", "id", i)))
    texts = spark.range(20_000).select(F.array_join(words, "").alias("text"))
    low = F.xxhash64(F.encode("text", "UTF-8")).bitwiseAND(F.lit((1 << 24) - 1))
    pairs = texts.groupBy(low).agg(F.sort_array(F.collect_list("text")).alias("t")).where(F.size("t") == 2).limit(3).collect()
    assert len(pairs) == 3
    long = [(2 * i, r.t[0]) for i, r in enumerate(pairs)]                     # a copy of only one text of each pair
    rows = [*long, *((None, t) for r in pairs for t in r.t)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = sorted((r.doc_id is None, r.n_bytes, r.n_removed, bytes(r.kept).decode())
                 for r in substrings.deduplicate(df, keep_text=True).collect())
    assert got == sorted([*((False, 160, 0, t) for _, t in long), *((True, 160, 160, "") for _ in pairs),
                          *((True, 160, 0, r.t[1]) for r in pairs)])
