from __future__ import annotations

import brute
import duckdb
import numpy as np
import pytest
from headway.llm import language, mixing, packing, pii, quality_model, quality_rules, tokens
from headway.llm.oracle import MIX_SQL
from headway.llm.queries import queries
from pyspark.sql import functions as F


def _texts(spark, d):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}


# ---------------------------------------------------------------- quality model

def test_quality_model_learns_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries()["op1_quality_model"](spark, d).collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    labels = spark.read.parquet(f"{d}/labels.parquet").collect()
    held = [(rows[x.doc_id].predicted, x.quality) for x in labels if rows[x.doc_id].held_out]
    assert len(held) > 40 and np.mean([p == q for p, q in held]) >= 0.95
    from zlib import crc32

    assert all(r.held_out == (crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())


def test_quality_model_odd_rows(spark, odd_documents, no_documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality_model.quality_report(odd_documents, none).collect()
    assert len(rows) == odd_documents.count() and {r.score for r in rows} == {0.5}
    some = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, 1), (4, None, 0), (None, 1, 0), (6, 1, 0), (8, 0, 0)],
                                 "doc_id long, quality int, toxic int")
    rows = quality_model.quality_report(odd_documents, some).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 5)}) == 1
    assert quality_model.quality_report(no_documents, some).count() == 0


# ---------------------------------------------------------------- personal data

def test_pii_base_equals_regular_expressions(spark, small):
    texts = _texts(spark, small)
    for r in queries()["op3_pii"](spark, small).collect():
        spans = brute.pii_base(texts[r.doc_id])
        assert r.base_sha256 == brute.sha(brute.spans_text(spans))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in spans) for k in brute.PII]
        assert set(filter(None, brute.spans_text(spans).split(","))) <= set(filter(None, r.spans.split(",")))


def _plain_discovered(texts):
    """The method's own spans, by plain loops: instances, patterns, scores refined in turn."""
    import re
    from collections import Counter, defaultdict

    word = r"[^\x20\x09-\x0D]"
    candidate = re.compile(rf"{word}*[0-9@]{word}*(?:\x20[(+]?[0-9]{word}*)*")
    marks = re.compile(rf"({word}+)[\x20\x09-\x0D]+$")
    guards = {k: re.compile(g) for k, g in pii.GUARDS.items()}

    def shape(hit):
        t = "".join("9" if "0" <= c <= "9" else "a" if c.isalpha() else c for c in hit)
        for m in "9a":
            t = re.sub(f"{m}{{5,}}", lambda x: m + ("+" if len(x[0]) < 9 else "++" if len(x[0]) < 17 else "+++"), t)
        return t

    def kind(hit):
        looks = [k for k in brute.PII if guards[k].search(hit) and re.search(brute.PII[k], hit)]
        held = {s[3] for s in brute.pii_base(hit)}
        return next((k for k in brute.PII if k in looks and k in held), "none" if looks else None)

    found = []
    for doc, text in texts.items():
        end = 0
        for m in candidate.finditer(text or ""):
            before = marks.search(text[end:m.start()])
            end = m.end()
            opened = re.sub(r"^[^A-Za-z0-9+(]+", "", m[0])
            hit = re.sub(r"[^A-Za-z0-9)]+$", "", opened)
            if len(hit) >= 4:
                at = m.start() + len(m[0]) - len(opened)
                found.append((doc, at, at + len(hit), hit, before[1].lower() if before else ""))
    edges = {(hit, kind(hit), f"{left} {x}") for _, _, _, hit, left in found for x in (shape(hit), "*")}
    seeds = defaultdict(Counter)
    for hit, k, pattern in edges:
        if k not in (None, "none"):
            seeds[pattern][k] += 1
    owner = {p: max((n, k) for k, n in c.items()) for p, c in seeds.items()}
    graph = [(h, k, p, owner[p][1]) for h, k, p in edges if p in owner and owner[p][0] >= pii.MIN_SEEDS]
    score = None
    for _ in range(pii.ROUNDS):
        total, n = defaultdict(float), Counter()
        known = defaultdict(list)
        for h, k, p, own in graph:
            if k is None and score:
                known[h, own].append(score[p])
        for h, k, p, own in graph:
            others = known[h, own]
            here = float(k == own) if k is not None else (sum(others) - score[p]) / (len(others) - 1) if len(others) > 1 else 0.0
            total[p] += here
            n[p] += 1
        score = {p: total[p] / (n[p] + 0.5) for p in n}
    new = {}
    for h, k, p, own in graph:
        if k is None and score[p] >= pii.MIN_SCORE:
            new[h] = max(new.get(h, (0, "")), (score[p], own))
    order = list(brute.PII)
    out = {}
    for doc, start, end, hit, _ in found:
        if hit in new:
            out.setdefault(doc, set()).add((start, order.index(new[hit][1]), end, new[hit][1]))
    return out


def test_pii_method_spans_equal_the_plain_version(spark):
    d = "/root/testdata/sf0.01"
    texts = _texts(spark, d)
    # more than the table has: identifiers that only their context gives away, and look-alikes
    more = {100_000 + i: f"Call the office phone {'+1 555 01%02d 4%03d' % (i, i) if i < 30 else 'x555-01%02d' % i} today" for i in range(60)}
    more |= {200_000 + i: f"card 4111 1111 1111 11{i:02d} end, serial 12-{i}" for i in range(40)}
    more |= {300_000 + i: f"please reach u{i}@host{i}.org soon" for i in range(60)}
    more |= {400_000 + i: f"please reach u{i}(at)host{i}.org soon" for i in range(2)}
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").unionAll(
        spark.createDataFrame(list(more.items()), "doc_id long, text string"))
    texts |= more
    want = _plain_discovered(texts)
    added = 0
    for r in pii.find(docs).collect():
        spans = sorted({*brute.pii_base(texts[r.doc_id]), *want.get(r.doc_id, ())})
        assert r.spans == brute.spans_text(spans), r.doc_id
        added += len(spans) - len(brute.pii_base(texts[r.doc_id]))
    assert added > 0


TRICKY = [
    "a@b.c_d@e.f.g x@y z@@q.r a.b@c-d.e+f@g.h", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1.2.3", "é@b.co ñ+1 234 567 8901é",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111", "5555555555554444123 0000000000000000 1 2 3 4",
    "+1(042)555-7845, +123456789 +12345678 ++49 (0) 30 123456..+1+1+1 +999999999999999999", "@ . + 1@2.3", "+1 2 3 4 5 6 7 8 9 ",
    "10.0.0.1:80 v1.2.3.4-5 999.999.999.999 1..2.3.4", "x" * 3000 + "@a.b " + "9" * 3000, "😀 a@b.co 😀 1.1.1.1",
    " ".join(f"u{i}@h{i}.org 10.0.{i % 300}.{i % 256}" for i in range(700)),
    "pay 4111 1111 1111 1111.",
]


def test_pii_tricky_texts_and_masks(spark):
    df = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    for r in pii.find(df).collect():
        assert r.base_sha256 == brute.sha(brute.spans_text(brute.pii_base(TRICKY[r.doc_id]))), TRICKY[r.doc_id][:80]
    masked = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert masked[10] == "😀 [EMAIL] 😀 [IP]" and masked[12] == "pay [CARD]." and "@h" not in masked[11]
    assert masked[7] == "[PHONE] "


def test_pii_words_of_a_million_characters(spark):
    """No pattern is tried again inside a word: a text of one long word takes seconds, not hours."""
    import time

    n = 1_000_000
    texts = ["x" * n + "9", "x" * n, "9" * n, "x" * n + "@" + "y" * n, "." * n + "7a", "7" + "." * n + "a", "x" * n + " 10.0.0.1",
             "+" * n + "1", "1.2." * (n // 4), "a." * (n // 2) + " 1", "(" * n + "1 2 3"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    pii.find(df.limit(1)).collect()
    began = time.time()
    got = {r.doc_id: r for r in pii.find(df).collect()}
    assert time.time() - began < 60
    # (the plain expressions would take hours here)
    assert [[got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] for i in range(len(texts))] == [
        [0, {6: 1, 8: n // 8}.get(i, 0), 0, 0] for i in range(len(texts))]
    assert got[6].spans == f"ip:{n + 1}:{n + 9}" and got[8].spans.startswith("ip:0:7,ip:8:15,")
    one = spark.createDataFrame([(texts[0],)], "t string").select(F.regexp_extract_all("t", F.lit(pii.CANDIDATE), F.lit(0)).alias("m"),
                                                                   pii._before(F.concat("t", F.lit(" "))).alias("w"))
    began = time.time()
    row = one.first()
    assert time.time() - began < 2 and row.m == [texts[0]] and row.w == texts[0]


def test_pii_masks_cut_the_spans_that_are_found(spark):
    """Spans of several kinds that overlap go whole; cuts behind wide characters and at both ends are in place."""
    texts = {"call +33 1.42.68.53.00 now": "call [PHONE] now", "+33 1.42.68.53.00": "[PHONE]",
             "😀é 10.0.0.1 +33 1.42.68.53.00 a@b.co": "😀é [IP] [PHONE] [EMAIL]", "1.2.3.4@b.co😀": "[EMAIL]😀",
             "a@b.c_d@e.f": "[EMAIL][EMAIL]", "no 4111 1111 1111 1111 1.2.3.4": "no [CARD] [IP]", "é": "é"}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def test_pii_patterns_discover_unseen_identifiers(spark):
    """'write to <address>' is learned from seeds and finds an address the base rule misses; counter-examples
    that fail a check are never proposed."""
    rows = [(i, f"please contactme user{i}@mail{i}.org today") for i in range(40)]
    rows += [(100, "please contactme bob1@localhost today"), (101, "number 1234567812345678 fails the check")]
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100] == "email:17:31" and got[101] == "" and got[3] == "email:17:32"
    masked = {r.doc_id: r.text for r in pii.mask(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert masked[100] == "please contactme [EMAIL] today" and masked[101] == rows[-1][1]


def test_pii_is_native(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for df in (pii.find(docs), pii.mask(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pii_odd_rows(spark, odd_documents, no_documents):
    rows = pii.find(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert {r.spans for r in rows if r.doc_id in (3, 4, 5)} == {""}
    masked = pii.mask(odd_documents)
    assert masked.columns == odd_documents.columns and masked.count() == odd_documents.count()
    assert masked.where("doc_id = 10").first().text == "mail [EMAIL] or [PHONE]"
    assert masked.where("doc_id = 3").first().text is None
    assert pii.find(no_documents).count() == 0 and pii.mask(no_documents).count() == 0


# ---------------------------------------------------------------- quality rules

def test_rules_base_figures(spark, small):
    texts = _texts(spark, small)
    rows = queries()["op4_quality_rules"](spark, small).collect()
    for r in rows:
        want = brute.rule_measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


@pytest.mark.parametrize("text", ["a b c a b c", "x x x x", "a b c d", "a b\x0bc\x0ca b c", "é | é\n\né | é\n \n é | é", "a\nb\na\n\n\n a\na"])
def test_rules_small_texts(text):
    assert quality_rules.measure(text.encode())[:5] == brute.rule_measures(text)


def test_label_model_recovers_accuracies():
    """Votes drawn from known accuracies: the posterior agrees with the truth, and a coin-toss rule is
    outvoted."""
    rng = np.random.default_rng(2)
    n, right = 20_000, [0.95, 0.9, 0.85, 0.5]
    truth = rng.random(n) < 0.8
    codes = np.zeros(n, int)
    for p in right:
        vote = np.where(rng.random(n) < p, truth, ~truth)
        vote = np.where(rng.random(n) < 0.3, quality_rules.ABSTAIN, np.where(vote, quality_rules.KEEP, quality_rules.REJECT))
        codes = codes * 3 + vote
    u, inverse, counts = np.unique(codes, return_inverse=True, return_counts=True)
    good = quality_rules.posteriors(u, counts.astype(float), 4)[inverse]
    assert np.mean((good >= 0.5) == truth) > 0.93
    assert len(quality_rules.posteriors(np.zeros(0, int), np.zeros(0), 4)) == 0


def test_rules_keep_labelled_good_and_reject_bad(spark):
    d = "/root/testdata/sf0.01"
    kept = {r.doc_id: (r.kept, r.base_failed) for r in queries()["op4_quality_rules"](spark, d).collect()}
    labels = spark.read.parquet(f"{d}/labels.parquet").collect()
    good = [kept[x.doc_id] for x in labels if x.quality == 1]
    bad = [kept[x.doc_id] for x in labels if x.quality == 0]
    assert np.mean([k or b for k, b in good]) > 0.98 and np.mean([not k for k, _ in bad]) > 0.9


def test_rules_odd_rows(spark, odd_documents, no_documents):
    rows = quality_rules.quality_report(odd_documents).collect()
    assert len(rows) == odd_documents.count() and not any(r.kept for r in rows if r.doc_id in (3, 4, 5, 7))
    kept = quality_rules.filter_documents(odd_documents)
    assert kept.columns == odd_documents.columns and {1, 2} <= {r.doc_id for r in kept.collect()}
    assert quality_rules.filter_documents(no_documents).count() == 0


# ---------------------------------------------------------------- packing

def _check_plan(histogram, capacity=2048, groups=64):
    plan, bins = packing.plan_bins(histogram, capacity, groups)
    used, ranks = {}, {}
    for length, rank, n, first, per, offset in plan.tolist():
        ranks.setdefault(length, []).append((rank, n))
        for i in range(n):
            used.setdefault(first + i // per, []).append((offset + i % per * length, length))
    for length, parts in ranks.items():
        at = 0
        for r, n in sorted(parts):
            assert r == at
            at += n
        assert at == histogram[length]
    assert set(ranks) == {k for k, v in histogram.items() if v}
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used)


def test_packing_plans_are_tight():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 300, 20_000):
        lengths = np.minimum(rng.lognormal(6, 1.1, n).astype(int) + 1, 2048)
        histogram = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}
        bins = _check_plan(histogram)
        if n >= 300:
            assert bins <= 1.03 * lengths.sum() / 2048 + 1
    assert _check_plan({5: 7}, capacity=10) == 4 and _check_plan({2048: 3, 1: 1}) == 4
    assert _check_plan({1500: 40, 500: 40, 48: 40}) == 40


def test_encoder_equals_the_tokenizer(spark, small):
    from tokenizers import Tokenizer

    texts = [*_texts(spark, small).values(), "", " ", "it's we'll I'd DON'T", "<|endoftext|> a<|startoftext|>b <|", "İstanbul ŉ ẞ ſ Ǆ",
             "éa ́x é", "a\x01b \x1c\x1d q", "x y z", "日本語 テスト 123 ½", "foo,bar. foo., ...,", "ÀÉ. É, ɐ.",
             "Σίσυφος ΟΔΟΣ.", "a.b c,d _x_ **bold**", "Plain, text. É1.5,x\n.a ,b", "a×, b÷. c", "e..f", "A.B.C., x"]
    tok = Tokenizer.from_file(tokens.default_path())
    flat, bounds = tokens.WordEncoder(tokens.default_path()).encode([t.encode() for t in texts])
    for i, e in enumerate(tok.encode_batch(texts, add_special_tokens=False)):
        assert flat[bounds[i]: bounds[i + 1]].tolist() == e.ids + [0]


def _check_packed(rows, want):
    """rows -> pieces; want: list of id lists, one per row of the table, by doc_id."""
    sequences, by_doc = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    expected = {}
    for doc_id, ids in want:
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a: a + 2048]
            expected.setdefault(doc_id, []).append((k, a, len(part), brute.ids_crc(part)))
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in expected.items()}


def test_packing_round_trip(spark, small, odd_documents, no_documents):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.default_path())
    ids = lambda t: tok.encode(t or "", add_special_tokens=False).ids + [0]
    rows = queries()["op7_packing"](spark, small).collect()
    want = [(i, ids(t)) for i, t in _texts(spark, small).items()]
    _check_packed(rows, want)
    total = sum(len(x) for _, x in want)
    assert len({r.sequence_id for r in rows}) <= 1.05 * total / 2048 + 1
    _check_packed(packing.pack(odd_documents).collect(), [(r.doc_id, ids(r.text)) for r in odd_documents.collect()])
    assert packing.pack(no_documents).count() == 0
    with_ids = packing.pack(odd_documents.where("doc_id != 6"), with_ids=True)
    assert sorted(x for r in packing.sequences(with_ids).collect() for x in r.ids) == sorted(
        x for r in odd_documents.where("doc_id != 6").collect() for x in ids(r.text))


# ---------------------------------------------------------------- mixing

def test_targets_by_hand(spark):
    """Budget 150 of 100 words: caps 20, 160, 20; weights 3, 1, 2: the small sources fill up, the rest is b's."""
    sized = spark.createDataFrame([(1, "a", 10), (2, "b", 80), (3, None, 10)], "doc_id long, source string, size long")
    got = {r.source: (r.no, r.target) for r in mixing.targets(sized).collect()}
    assert got == {"a": (1, 20.0), "b": (2, 110.0), None: (3, 20.0)}


def test_mix_reaches_targets_and_agrees_with_sql(spark):
    d = "/root/testdata/sf0.01"
    rows = queries()["op8_mixing"](spark, d).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet')")
    want = {r[0]: r[1:] for r in con.execute(MIX_SQL).fetchall()}
    assert {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in rows} == want
    assert all(r.taken in (0, r.size, 2 * r.size) for r in rows)


def test_mix_spreads_rows_of_one_doc_id(spark, monkeypatch):
    """A third of all rows without a doc_id, many of them equal: several ranges, and running totals without gaps."""
    monkeypatch.setattr(mixing, "RANGE_DOCS", 7)
    rows = [(None, "a", i if i < 800 else 0, 1 + (i * 7) % 5 if i < 800 else 3) for i in range(1000)]
    rows += [(i, "ab"[i % 2], i, 1 + i % 4) for i in range(2000)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, sign long, size long")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        got = mixing.queued(sized, mixing.targets(sized)).collect()
    finally:
        spark.conf.unset(coalesce)
    assert sorted((r.doc_id or -1, r.source, r.sign, r.size) for r in got) == sorted((r[0] or -1, *r[1:]) for r in rows)
    assert len({r.range for r in got if r.doc_id is None}) > 1
    for s in "ab":
        done = 0
        for r in sorted((r for r in got if r.source == s), key=lambda r: r.done):
            assert r.done - r.size == done
            done = r.done


def test_mix_odd_rows_and_ranges(spark, odd_documents, no_documents, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_DOCS", 3)
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 30))), f"s{rng.integers(0, 4) ** 2}") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = sorted(mixing.mix_report(df).collect())
    assert first == sorted(mixing.mix_report(df.repartition(7)).collect())
    source = {i: s for i, _, s in rows}
    taken, target = {}, {}
    for r in first:
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)
    report = mixing.mix_report(odd_documents).collect()
    assert len(report) == odd_documents.count() and all(r.taken <= 2 * r.size for r in report)
    out = mixing.mix(odd_documents)
    assert out.columns == odd_documents.columns
    assert out.count() == sum(r.taken // r.size for r in report if r.size)
    assert mixing.mix_report(no_documents).count() == 0 and mixing.mix(no_documents).count() == 0


# ---------------------------------------------------------------- language

def _best(scores, switch):
    v = scores[0].copy()
    for e in scores[1:]:
        v = np.maximum(v, v.max() - switch) + e
    return v.max()


def test_viterbi_is_optimal():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 5, 300, 128, 129, 0, 1000, 257, 3]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    scores = np.cumsum(rng.normal(size=(bounds[-1], 4)), axis=0) * 0.2 + rng.normal(size=(bounds[-1], 4))
    path = language.viterbi(scores, bounds, 3.0)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            p, s = path[a:b], scores[a:b]
            assert abs(s[np.arange(b - a), p].sum() - 3 * np.count_nonzero(np.diff(p)) - _best(s, 3.0)) < 1e-6


def test_language_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries()["op10_language"](spark, d).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()}
    held = [(r.lang_pred, truth[i]) for i, r in rows.items() if r.held_out]
    assert len(held) > 150 and np.mean([a == b for a, b in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_viterbi_of_more_than_128_languages():
    rng = np.random.default_rng(6)
    for k in (2, 128, 129, 300):
        truth = np.repeat(rng.permutation(k)[:20] if k > 20 else np.arange(20) % k, 30)
        truth[:30] = k - 1
        scores = rng.random((len(truth), k))
        scores[np.arange(len(truth)), truth] += 20
        got = language.viterbi(scores, np.array([0, 30, 60, len(truth)]))    # short texts and one of several rows
        assert got.tolist() == truth.tolist()


def test_language_spans_of_mixed_text(spark):
    german, french = "der hund und die katze sind nicht in dem haus ", "le chat est dans la maison avec les enfants "
    train = spark.createDataFrame([(german * 20, "de"), (french * 20, "fr"), ("привет мир это дом " * 20, "ru")], "text string, lang string")
    model = language.train(train)
    docs = spark.createDataFrame([(1, german * 4 + french * 3), (2, "дом und мир"), (3, "λόγος"), (4, None), (5, "12 34")], "doc_id long, text string")
    got = {r.doc_id: r for r in language.predict(docs, model, ["doc_id"], spans=True).collect()}
    assert [(s.first_word, s.lang) for s in got[1].spans] == [(0, "de"), (40, "fr")] and got[1].lang_pred == "de"
    assert got[2].lang_pred == "ru" and got[4].lang_pred == got[5].lang_pred == "und"
    assert got[3].lang_pred in ("de", "fr", "ru") and got[3].score == 0


def test_language_odd_rows(spark, odd_documents, no_documents):
    rows = language.language_report(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5, 8)} == {"und"}
    assert {r.lang_pred for r in language.language_report(odd_documents.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.language_report(no_documents).count() == 0


def test_quality_model_learns_from_a_bounded_number_of_rows(spark, monkeypatch):
    """One labelled doc_id that stands for most rows: no more than the sample reaches the driver."""
    seen = []
    fit = quality_model.Network.fit
    monkeypatch.setattr(quality_model.Network, "fit", lambda self, x, y: seen.append(len(x)) or fit(self, x, y))
    word = lambda i: "".join(chr(97 + i // 26 ** k % 26) for k in range(3))
    rows = [(7, f"good {word(i)} in a {word(7 * i)} text {word(i * i)}") for i in range(3000)] + [(i, f"bad! {word(i)} $$ {word(3 * i)}") for i in range(100, 1100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1)] + [(i, 0) for i in range(100, 1100)], "doc_id long, quality int")
    got = quality_model.quality_scores(docs, labels, [F.col("doc_id")], F.lit(True), sample=100).collect()
    assert len(got) == len(rows) and 60 <= seen[0] <= 100 and len(seen) == 1
