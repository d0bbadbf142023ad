from __future__ import annotations

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from headway.llm import spelling
from headway.llm.queries import queries
from pyspark.sql import functions as F

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def _near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1:] == short for i in range(len(long_)))


def _plain(rows):
    """The contract word by word: every pair of words is compared (by length, then letter by letter)."""
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    keyed = {}                                  # words one edit apart are equal without one letter of either
    for w in n:
        for v in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            keyed.setdefault(v, []).append(w)
    near = {w: set() for w in n}
    for ws in keyed.values():
        for a in ws:
            near[a].update(b for b in ws if _near(a, b))
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def _rows(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_query_equals_plain_version(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    expected = _plain(rows)
    assert _rows(queries()["op11_spelling"](spark, d)) == expected
    assert sum(r[1] is not None for r in expected) > 100


@pytest.mark.parametrize("block_words", [spelling.BLOCK_WORDS, 3, 1])
def test_hot_blocks_and_chains(spark, block_words):
    """Words that nearly all share their first and last halves, chains of forms, letters beyond ASCII."""
    rng = random.Random(5)
    words = ["inter" + "".join(rng.choice("abßé") for _ in range(rng.randint(0, 4))) + "tions" for _ in range(150)]
    words += ["".join(rng.choice("xy") for _ in range(rng.randint(4, 7))) for _ in range(60)]
    words += ["chainaaaa"] * 60 + ["chainaaab"] * 25 + ["chainaabb"] * 12 + ["chainabbb"] * 5 + ["ÀÉÎõü", "×÷×÷×"] * 4
    rows = [(i % 40 if i % 9 else None, " ".join(rng.choices(words, k=30)) + ("., 中文abcdeƀ" * 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("word", F.lit(1))
    got = _rows(spelling.variants(df, block_words))
    assert got == _plain(rows)
    assert len({r[2] for r in got if r[0].startswith("chaina")}) < len([r for r in got if r[0].startswith("chaina")])


def test_scan_finds_every_pair_once():
    rng = random.Random(1)
    for letters, sizes in (("ab", (5, 9)), ("abcdé", (5, 7))):
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(300)})
        blocks, got = {}, []
        for w in words:
            for longest in (len(w), len(w) + 1):
                half = longest // 2
                blocks.setdefault((0, longest, w[:half]), []).append(w)
                blocks.setdefault((1, longest, w[::-1][:longest - half]), []).append(w[::-1])
        for (side, longest, _), ws in blocks.items():
            ws = sorted(ws)
            q, e = spelling.scan(ws, ws, np.tile([[0, len(ws)]], (len(ws), 1)), side, longest)
            got += [(ws[i][::-1], ws[j][::-1]) if side else (ws[i], ws[j]) for i, j in zip(q, e)]
        assert sorted(got) == sorted((a, b) for a in words for b in words if _near(a, b))


def test_very_long_words(spark):
    long_ = "abc" * 40_000
    rows = [(1, f"{long_} {long_[:-1]}x {long_}"), (2, f"{long_} {long_[:-1]}x {long_[1:]}"), (3, f"{long_[:-1]}x {long_[1:]} " * 2)]
    assert _rows(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), 2)) == _plain_long(rows)


def _plain_long(rows):
    counts = Counter()
    for doc, text in rows:
        for run in text.split():
            h = crc32(f"{doc}:{run}".encode())
            counts[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in counts.items() if c >= 3}

    def near(a, b):
        p = len(__import__("os").path.commonprefix([a, b]))
        s = len(__import__("os").path.commonprefix([a[::-1], b[::-1]]))
        return a != b and abs(len(a) - len(b)) <= 1 and p + s >= max(len(a), len(b)) - 1

    out = []
    for w in n:
        vs = [v for v in n if near(w, v)]
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= 2 * n[w] else None
        out.append((w, form, form or w, n[w], len(vs), n[form] if form else None))
    return sorted(out)


def test_odd_and_empty_tables(spark, odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert _rows(spelling.variants(odd_documents)) == _plain(rows)
    assert _rows(spelling.variants(no_documents)) == []
