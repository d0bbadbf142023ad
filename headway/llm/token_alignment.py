"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

A is a byte-level BPE file, B a SentencePiece model; A reads space + text, B adds its own space.  Every
text is tokenised in full by both.  A place where tokens of both end and both next tokens begin with a
space is a verified anchor; anchors cut a text into windows of token ids, and what a window's groups,
links and their printed form are is kept in a memo.

Neither tokenizer joins across a place where a space follows a character that is no white space (A splits
there before merging; no piece of B holds a space behind anything else, which is checked when the model
is read; else texts are not cut), so a text's ids are those of its space-led words.  The words that a worker has not met are
joined with spaces, tokenised at one go, and cut again at their verified anchors; the memo is
keyed by the window's characters, which both id tuples spell, instead of by the tuples.  A full memo starts anew.

Corpus-wide counts: texts are taken in chunks of bounded size; a chunk sends each of its id pairs once, with
the number of its texts that hold it.  Sums per pair and the highest sum per A id go back to the chunks, each
a bounded list, and a chunk's texts are scored against its own list.  No table of pairs is broadcast.

Defined results: null and empty texts, and texts whose joined bytes of A or B differ from space + text
(a literal U+2581), have no tokens: zeros and an empty digest.  Repeated rows are documents of their own in
every count.  A null doc_id is kept.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import lasting, prepare, stored
from headway.llm.tokens import _byte_letters

CHUNK_LINKS = 1_500_000     # links after which a chunk closes
MEMO = 250_000              # windows that a worker keeps
JOINED = 5_000              # new words that are tokenised at one go
PART_BYTES = 1_500_000      # bytes of texts (one text at least) that are looked at together
UNJOINED = re.compile(r"(?<=\S)(?= )")              # a space behind no white space
BLANK_PAIR = re.compile(r"\s ")
ASCII_BLANK_PAIRS = [c + " " for c in " \t\n\v\f\r\x1c\x1d\x1e\x1f"]
REPORT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")
CHUNK = ("chunk long, doc_id array<long>, n_a binary, n_b binary, n_groups binary, sha array<string>, "
         "held binary, place binary, times binary, pairs binary, texts binary")
SCORES = "chunk long, counts binary, best binary"


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def words_of(text: str) -> list[str]:
    """Space + text cut before every space behind no white space; each word without its first space.

    A single space at the end stays with the word before it (B cannot be given a space alone)."""
    simple = not any(p in text for p in ASCII_BLANK_PAIRS) if text.isascii() else not BLANK_PAIR.search(text)
    if simple and text[:1] != " " and text[-1:] != " ":
        return text.split(" ")
    parts = UNJOINED.split(" " + text)
    if len(parts) > 1 and parts[-1] == " ":
        parts[-2:] = [parts[-2] + " "]
    return [p[1:] for p in parts]


class Pair:
    """The two tokenizers, and what is known of windows in this worker."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()                      # byte-level alphabet: the other bytes stand for themselves
        back = {chr(letters.get(b, b)): b for b in range(256)}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(back[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.size_a, self.size_b = [np.array([len(x) for x in table]) for table in (self.bytes_a, self.bytes_b)]
        self.led_a, self.led_b = [np.array([x[:1] == b" " for x in table]) for table in (self.bytes_a, self.bytes_b)]
        # printed ids: followed by a comma, by the bar, by a semicolon, by the end of a window
        self.most = max(len(self.bytes_a), len(self.bytes_b))
        self.printed = [f"{i}{mark}" for mark in ",|;\n" for i in range(self.most)]
        self.reset()

    def reset(self) -> None:
        self.code: dict[str, int] = {}
        self.shown: list[bytes] = []
        self.figures = np.zeros((1 << 14, 5), np.int64)       # n_a, n_b, n_groups, n_links, first link
        self.links = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _align(self, words: list[str], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray] | None:
        """Figures, printed groups and links of words from the ids of their joined text; None if its bytes are not
        the tokens' bytes or a word does not begin at an anchor."""
        whole = (" " + " ".join(words)).encode()
        if b"".join([self.bytes_a[t] for t in a.tolist()]) != whole or b"".join([self.bytes_b[t] for t in b.tolist()]) != whole:
            return None
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        word_end = np.cumsum([len(w.encode()) + 1 for w in words])
        ends = np.intersect1d(end_a, end_b, assume_unique=True)          # where groups end
        if not np.isin(word_end, ends).all():
            return None
        starts = word_end[:-1]                                          # anchors: both next tokens are led by a space
        if not (self.led_a[a[np.searchsorted(end_a, starts) + 1]].all() and self.led_b[b[np.searchsorted(end_b, starts) + 1]].all()):
            return None
        group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        in_a, in_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
        upto_a, upto_b = np.cumsum(in_a), np.cumsum(in_b)
        word = np.searchsorted(word_end, ends)                           # the word of a group
        n = in_a * in_b
        n_words = len(words)
        figures = np.stack([np.bincount(word, x, n_words).astype(np.int64) for x in (in_a, in_b, np.ones(len(ends)), n)], 1)
        group = np.repeat(np.arange(len(ends)), n)
        at = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
        links = (a[(upto_a - in_a)[group] + at // in_b[group]] << 16) + b[(upto_b - in_b)[group] + at % in_b[group]]
        # print: the A ids of a group, then its B ids
        order = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[upto_a - 1] = 1
        last_b[upto_b - 1] = 2 + (np.append(word[1:], -1) != word)
        order[np.arange(len(a)) + (upto_b - in_b)[group_a]] = a + last_a * self.most
        order[np.arange(len(b)) + upto_a[group_b]] = b + last_b * self.most
        shown = "".join([self.printed[i] for i in order.tolist()]).encode().split(b"\n")[:-1]
        return figures, shown, links

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if not w[-1:].isspace()]               # others cannot be followed by a space
        jobs = [plain[i:i + JOINED] for i in range(0, len(plain), JOINED)] if self.cuts else [[w] for w in plain]
        jobs += [[w] for w in words if w[-1:].isspace()]
        while jobs:
            later, jobs = jobs[4:], jobs[:4]
            texts = [" ".join(job) for job in jobs]
            of_a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
            of_b = self.b.encode(texts, num_threads=1)
            again = []
            for job, x, y in zip(jobs, of_a, of_b):
                found = self._align(job, np.array(x.ids, np.int64), np.array(y, np.int64))
                if found is not None:
                    self._keep(job, *found)
                elif len(job) == 1:
                    self._keep(job, np.array([[-1, 0, 0, 0]]), [b""], np.zeros(0, np.int64))
                else:                                                    # some word's bytes are not its tokens' bytes
                    again += [job[:len(job) // 2], job[len(job) // 2:]]
            jobs = again + later

    def _keep(self, words: list[str], figures: np.ndarray, shown: list[bytes], links: np.ndarray) -> None:
        at, n = len(self.code), len(words)
        while at + n > len(self.figures):
            self.figures = np.concatenate([self.figures, np.zeros_like(self.figures)])
        while self.used + len(links) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.figures[at: at + n, :4] = figures
        self.figures[at: at + n, 4] = self.used + np.cumsum(figures[:, 3]) - figures[:, 3]
        self.links[self.used: self.used + len(links)] = links
        self.used += len(links)
        self.shown += shown
        self.code.update(zip(words, range(at, at + n)))

    def texts(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Figures (n_a, n_b, n_groups) and digest of every text; the text number and the pair of every link."""
        if len(self.code) > MEMO:
            self.reset()
        words = [words_of(t) if t and "▁" not in t else [] for t in texts]
        if not self.cuts:
            words = [[t] if w else [] for t, w in zip(texts, words)]
        flat = list(chain.from_iterable(words))
        codes = np.fromiter(map(self.code.get, flat, repeat(-1)), np.int64, len(flat))
        unknown = np.flatnonzero(codes < 0)
        if len(unknown):
            fresh = [flat[i] for i in unknown.tolist()]
            self._learn(list(dict.fromkeys(fresh)))
            codes[unknown] = np.fromiter(map(self.code.__getitem__, fresh), np.int64, len(fresh))
        per = np.array([len(w) for w in words], np.int64)
        number = np.repeat(np.arange(len(texts)), per)
        rows = self.figures[codes]
        bad = np.zeros(len(texts), bool)
        bad[number[rows[:, 0] < 0]] = True
        sums = np.zeros((len(texts), 3), np.int64)
        for k in range(3):
            sums[:, k] = np.bincount(number, rows[:, k], len(texts)).astype(np.int64)
        sums[bad] = 0
        shas, at = [], 0
        for n, b in zip(per.tolist(), bad.tolist()):
            if n and not b:
                shas.append(hashlib.sha256(b";".join([self.shown[c] for c in codes[at: at + n].tolist()])).hexdigest())
            else:
                shas.append("")
            at += n
        good = ~bad[number]
        number, rows = number[good], rows[good]
        n = rows[:, 3]
        upto = np.cumsum(n)
        links = self.links[np.repeat(rows[:, 4] - (upto - n), n) + np.arange(upto[-1] if len(upto) else 0)]
        return sums, shas, np.repeat(number, n), links


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of ``PART_BYTES`` at most (or of one text)."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    first, held = 0, 0
    for i, n in enumerate(sizes):
        if held + n > PART_BYTES and i > first:
            yield first, i
            first, held = i, 0
        held += n
    if len(sizes) > first:
        yield first, len(sizes)


@lru_cache(2)
def pair(path_a: str, path_b: str) -> Pair:
    return lasting(Pair(path_a, path_b))


def _text(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "replace")


def _chunks(paths: tuple[str, str], most: int):
    """Documents -> one row per chunk: its texts' figures, and each id pair once with its number of texts."""

    def close(no: int, docs: list, sums: list, shas: list, held: list, pairs: list, times: list) -> pa.RecordBatch:
        figures = np.concatenate(sums)
        all_pairs = np.concatenate(pairs)
        distinct, place, texts = np.unique(all_pairs, return_inverse=True, return_counts=True)
        chunk = (TaskContext.get().partitionId() << 24) + no
        cells = [chunk, docs, *[figures[:, k].astype("<i8").tobytes() for k in range(3)], shas,
                 np.concatenate(held).astype("<i4").tobytes(), place.astype("<i4").tobytes(),
                 np.concatenate(times).astype("<i4").tobytes(), distinct.astype("<i8").tobytes(),
                 texts.astype("<i4").tobytes()]
        kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 3, pa.list_(pa.string()), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)],
                                          names=[c.split()[0] for c in CHUNK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(*paths)
        docs, shas, sums, held, pairs, times, links, no = [], [], [], [], [], [], 0, 0
        collects = gc.isenabled()
        gc.disable()                                   # many small objects, no cycles
        try:
            for b, first, end in ((b, *part) for b in batches for part in _parts(b.column(1))):
                docs += b.column(0)[first:end].to_pylist()
                one, sha, number, link = both.texts([_text(t) for t in b.column(1)[first:end].to_pylist()])
                sums.append(one)
                shas += sha
                key, n = np.unique((number << 32) | link, return_counts=True)
                held.append(np.bincount(key >> 32, minlength=len(one)))
                pairs.append(key & 0xFFFFFFFF)
                times.append(n)
                links += len(link)
                if links > most:
                    yield close(no, docs, sums, shas, held, pairs, times)
                    docs, shas, sums, held, pairs, times, links, no = [], [], [], [], [], [], 0, no + 1
            if docs:
                yield close(no, docs, sums, shas, held, pairs, times)
        finally:
            if collects:
                gc.enable()

    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk -> a row per id pair: place in the chunk, A id, B id, number of the chunk's texts."""
    for b in batches:
        for chunk, pairs, texts in zip(*(c.to_pylist() for c in b.columns)):
            p = np.frombuffer(pairs, "<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(p), chunk)), pa.array(np.arange(len(p), dtype=np.int32)),
                 pa.array((p >> 16).astype(np.int32)), pa.array((p & 0xFFFF).astype(np.int32)),
                 pa.array(np.frombuffer(texts, "<i4").astype(np.int64))], names=["chunk", "place", "a", "b", "texts"])


def _sums(values: np.ndarray, held: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(held, dtype=np.int64)
    return upto[ends] - upto[ends - held]


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk and the corpus-wide counts of its pairs -> one row per text."""
    for b in batches:
        for r in range(b.num_rows):
            c = {name: b.column(i)[r] for i, name in enumerate(b.schema.names)}
            raw = {k: np.frombuffer(c[k].as_py() or b"", t) for k, t in
                   (("n_a", "<i8"), ("n_b", "<i8"), ("n_groups", "<i8"), ("held", "<i4"), ("place", "<i4"),
                    ("times", "<i4"))}
            counts = np.array(c["counts"].as_py() or [], np.int64)
            best = np.array(c["best"].as_py() or [], np.int64)
            held, times = raw["held"].astype(np.int64), raw["times"].astype(np.int64)
            columns = [raw["n_a"], raw["n_b"], raw["n_groups"], _sums(times, held), _sums(times * best[raw["place"]], held),
                       _sums(times * counts[raw["place"]], held)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c["doc_id"].as_py(), pa.int64()), *[pa.array(x, pa.int64()) for x in columns],
                 pa.array(c["sha"].as_py(), pa.string())], names=[x.split()[0] for x in REPORT.split(", ")])


def pair_counts(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Id pairs of every chunk, and corpus-wide: in how many texts a pair is linked, and the most of its A id."""
    spread = chunks.select("chunk", "pairs", "texts").mapInArrow(
        _spread, "chunk long, place int, a int, b int, texts long")
    counts = spread.groupBy("a", "b").agg(F.sum("texts").alias("count"))
    return spread, counts


def align_documents(docs: DataFrame, paths: tuple[str, str] | None = None, chunk_links: int = CHUNK_LINKS) -> DataFrame:
    """One row per document (``REPORT``)."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "UTF-8").alias("text"))
    chunks = stored(texts.mapInArrow(_chunks(paths or default_paths(), chunk_links), CHUNK), "alignment-chunks")
    spread, counts = pair_counts(chunks)
    counts = stored(counts, "alignment-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    marked = counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))
    # a chunk's list is as long as the chunk allows
    scores = (spread.join(marked, ["a", "b"]).groupBy("chunk")
              .agg(F.sort_array(F.collect_list(F.struct("place", "count", "best"))).alias("s"))
              .select("chunk", F.col("s.count").alias("counts"), F.col("s.best").alias("best")))
    whole = chunks.select("chunk", "doc_id", "n_a", "n_b", "n_groups", "sha", "held", "place", "times")
    return whole.join(scores, "chunk", "left").drop("chunk").mapInArrow(_score, REPORT)
