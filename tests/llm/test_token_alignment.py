from __future__ import annotations

import hashlib
import random
from bisect import bisect_right
from collections import Counter

import pytest
from headway.llm import token_alignment as T
from headway.llm.queries import queries
from headway.session import scratch_path
from pyspark.sql import functions as F


def _plain_tokens(text):
    """Ids and byte ends of both tokenizers over the whole text, or None."""
    import sentencepiece
    from tokenizers import Tokenizer

    if "tok" not in _plain_tokens.__dict__:
        path_a, path_b = T.default_paths()
        tok = Tokenizer.from_file(path_a)
        tok.encode_special_tokens = True
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        back = {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}
        _plain_tokens.tok = tok
        _plain_tokens.back = back
        _plain_tokens.sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
    tok, sp, back = _plain_tokens.tok, _plain_tokens.sp, _plain_tokens.back
    if not text:
        return None
    whole = (" " + text).encode()
    a = tok.encode(" " + text, add_special_tokens=False).ids
    b = sp.encode(text)
    bytes_a = [bytes(back[c] for c in tok.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i) else
               sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    return a, bytes_a, b, bytes_b


def _plain(rows):
    """The contract, text by text: groups from the sets of ends, links per group, counts over all texts."""
    found, held = [], Counter()
    for doc, text in rows:
        got = _plain_tokens(text)
        groups = []
        if got:
            a, bytes_a, b, bytes_b = got
            ends = [[], []]
            for out, parts in zip(ends, (bytes_a, bytes_b)):
                at = 0
                for p in parts:
                    at += len(p)
                    out.append(at)
            low = [0, 0]
            for end in sorted(set(ends[0]) & set(ends[1])):
                high = [bisect_right(e, end) for e in ends]
                groups.append((a[low[0]:high[0]], b[low[1]:high[1]]))
                low = high
        links = Counter((x, y) for p, q in groups for x in p for y in q)
        held.update(links.keys())
        found.append((doc, len(got[0]) if got else 0, len(got[2]) if got else 0, groups, links))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for doc, n_a, n_b, groups, links in found:
        shown = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((doc, n_a, n_b, len(groups), sum(links.values()),
                    sum(m for k, m in links.items() if held[k] == most[k[0]]),
                    sum(m * held[k] for k, m in links.items()),
                    hashlib.sha256(shown.encode()).hexdigest() if shown else ""))
    return sorted(out, key=str)


def _rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                       "groups_sha256").collect()), key=str)


ODD = ["", None, " ", "  ", " a", "a ", "a  ", "a  b", "a\n", "\n", "\n\n a", "a\n\nb", "a \n b", "x\ty \t z", "word. Next,word!? (x)",
       "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "▁", "日本語 の テキスト", "ﬁ ½ é é", "😀😀 😀", "a b 　c", "\x00 \x01a",
       "I'm don't we'll 's", "1234567 12.5%  3", "naïve.Ça\nva, où?", "a.b,c;d:e", "..,, ..", "x\x1c y", "ab" * 5000, "a b " * 3000,
       "​ a‍", "A\r\nB \r\nC", "tab\tend\t", "end.\n", "end.\n ", "end. \n", " x   y", "İstanbul ǅ ß", "a!\n!b ?\n"]


@pytest.mark.parametrize("chunk_links", [T.CHUNK_LINKS, 50])
def test_odd_texts_equal_whole_text_tokenisation(spark, chunk_links):
    rows = [(i if i % 7 else None, t) for i, t in enumerate(ODD + ODD[3:20])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("chunk", F.lit("x")).withColumn("a", F.lit(1))
    assert _rows(T.align_documents(df.repartition(3), chunk_links=chunk_links)) == _plain(rows)


def test_random_texts_equal_whole_text_tokenisation():
    rng = random.Random(3)
    both = T.Pair(*T.default_paths())
    marks = [" ", " ", " ", "  ", "\n", ".", ",", "!", "'s", "é", "ß", "x", "the", "and", "Ing", "9", "\t", "-", "…", " ", "中", "a"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(1, 30))) for _ in range(4000)]
    sums, shas, number, links = both.texts(texts)
    expected = {(r[0]): r for r in _plain(list(enumerate(texts)))}
    for i, text in enumerate(texts):
        assert (*sums[i].tolist(), shas[i]) == (*expected[i][1:4], expected[i][7]), repr(text)


def test_small_memo_gives_the_same(monkeypatch):
    monkeypatch.setattr(T, "MEMO", 5)
    both, texts = T.Pair(*T.default_paths()), ["one two, three.\nfour one two " * 3, "five six seven eight nine ten", "one nine"]
    expected = {r[0]: r for r in _plain(list(enumerate(texts)))}
    for _ in range(3):
        for i, t in enumerate(texts):
            sums, shas, _, _ = both.texts([t])
            assert (*sums[0].tolist(), shas[0]) == (*expected[i][1:4], expected[i][7])


def test_query_equals_plain_version(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert _rows(queries()["op12_alignment"](spark, small)) == _plain(rows)


def test_odd_and_empty_tables(spark, odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert _rows(T.align_documents(odd_documents)) == _plain(rows)
    assert _rows(T.align_documents(no_documents)) == []
    path = scratch_path(spark, "alignment")
    odd_documents.write.parquet(path)
    assert len(_rows(T.align_documents(spark.read.parquet(path)))) == len(rows)
