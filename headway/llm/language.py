"""Language identification: script ranges, word scores and a Viterbi pass with a switching penalty.

Training counts, over all training documents, hashed character bigrams and trigrams (with word ends)
per language and letters per script and language: fixed-size tables that every task adds up and one
shuffle sums.  A word's candidates are the languages that use its script; its score is the sum of the
n-gram log probabilities.  A Viterbi pass over the words of a text, whose only transition cost is a
penalty for switching, labels spans of one language each; the document's language is the one with
most letters, ties to the smaller name.

The pass is exact and runs over all texts of a batch at once: texts are cut into rows of ``ROW`` words,
each row's best paths are found for every state it may be entered in, and rows are then chained, so a
very long text costs as many steps as a short one.

Defined cases: a text that is null or has no letters is ``und`` with score 0; a text whose letters are
all in scripts no language uses takes the language with most training letters, score 0; without
training documents everything is ``und``; repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import WordMemo, prepare, sum_blocks

BINS = 1 << 15
BLOCK = 1 << 10
SWITCH = 8.0
SMOOTH = 0.5
SCRIPT_SHARE = 0.01
ROW = 128
# fixed values: first and last code points of scripts (everything else is "other")
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("hangul_jamo", 0x1100, 0x11FF),
    ("latin_more", 0x1E00, 0x1EFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)
_FIRST = [s[1] for s in SCRIPTS]
_OTHER = len(SCRIPTS)


def script_of(char: str) -> int:
    c = ord(char)
    i = bisect_right(_FIRST, c) - 1
    return i if i >= 0 and c <= SCRIPTS[i][2] else _OTHER


def letters_of(word: bytes) -> str:
    w = word.decode("utf-8", "replace").lower()
    return w if w.isalpha() else "".join(filter(str.isalpha, w))


def ngram_bins(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bin) of every bigram and trigram of words with ends marked."""
    cp = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    own = np.cumsum(cp == 0) - 1
    own[cp == 0] = -1
    mix = lambda h: ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64)
    a, b = cp[:-1], cp[1:]
    two = np.maximum(own[:-1], own[1:])
    keep2 = two >= 0
    three = own[1:-1]
    keep3 = three >= 0
    bins2 = mix((a << np.uint64(21) | b) + np.uint64(1))[keep2]
    bins3 = mix((cp[:-2] << np.uint64(42)) ^ (cp[1:-1] << np.uint64(21)) ^ cp[2:] ^ np.uint64(1 << 63))[keep3]
    return np.concatenate([two[keep2], three[keep3]]), np.concatenate([bins2, bins3])


# ---------------------------------------------------------------- training

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams: dict[str, np.ndarray] = {}
    for b in batches:
        by_lang: dict[str, Counter] = {}
        for text, lang in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist()):
            by_lang.setdefault(lang, Counter()).update((text or b"").split())
        for lang, counter in by_lang.items():
            words, weights = [], []
            for w, n in counter.items():
                s = letters_of(w)
                if s:
                    words.append(s)
                    weights.append(n)
            if not words:
                continue
            table = grams.setdefault(lang, np.zeros(BINS + BLOCK, np.int64))
            weight = np.array(weights, np.int64)
            own, bins = ngram_bins(words)
            table[:BINS] += np.bincount(bins, weight[own], BINS).astype(np.int64)
            for w, n in zip(words, weights):
                table[BINS + script_of(w[0])] += n * len(w)
    for lang, table in grams.items():
        parts = table.reshape(-1, BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(parts)), pa.array(np.arange(len(parts), dtype=np.int32)),
             pa.array([p.astype("<i8").tobytes() for p in parts], pa.binary())], names=["name", "block", "counts"])


class Model:
    """Log probabilities [bin, language] and the languages that use each script."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        total = counts.sum(axis=0, keepdims=True)
        self.logp = np.log((counts + SMOOTH) / (total + SMOOTH * BINS)).astype(np.float32)
        if len(langs):
            self.logp -= self.logp.mean(axis=1, keepdims=True)
        share = scripts / np.maximum(scripts.sum(axis=0, keepdims=True), 1)
        self.uses = share >= SCRIPT_SHARE                     # [script, language]
        self.common = int(scripts.sum(axis=0).argmax()) if len(langs) else -1

    def rows(self, words: list[bytes]) -> np.ndarray:
        """Scores per language and the number of letters of every word."""
        texts = [letters_of(w) for w in words]
        out = np.zeros((len(words), len(self.langs) + 1), np.float32)
        out[:, -1] = [len(t) for t in texts]
        own, bins = ngram_bins(texts)
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(own, self.logp[bins, k], len(words))
        script = np.array([script_of(t[0]) if t else -1 for t in texts])
        for s in np.unique(script[script >= 0]):
            rows, uses = script == s, self.uses[s]
            if uses.any():
                for k in np.flatnonzero(~uses):
                    out[rows, k] = -1e4
            else:
                out[rows, :-1] = 0                             # no candidate: the word tells nothing
        return out


def train(docs: DataFrame) -> Model:
    """``docs(text, lang)``: every row counts."""
    parts = docs.select("text", "lang").mapInArrow(_count, "name string, block int, counts binary")
    got: dict[str, np.ndarray] = {}
    for r in sum_blocks(parts).collect():                      # a fixed-size table per language
        got.setdefault(r["name"], np.zeros(BINS + BLOCK, np.int64))[
            r["block"] * BLOCK: (r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], "<i8")
    langs = sorted(got)
    if not langs:
        return Model([], np.zeros((BINS, 0)), np.zeros((_OTHER + 1, 0)))
    both = np.stack([got[k] for k in langs], axis=1)
    return Model(langs, both[:BINS], both[BINS: BINS + _OTHER + 1])


# ---------------------------------------------------------------- Viterbi

def viterbi(scores: np.ndarray, bounds: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of every word: scores [words, languages] of texts given by their bounds."""
    n, k = scores.shape
    if not n or k < 2:
        return np.zeros(n, np.int64)
    size = np.diff(bounds)
    per = -(-size // ROW)                                      # rows of each text
    row_doc = np.repeat(np.arange(len(size)), per)
    row_no = np.arange(len(row_doc)) - np.repeat(np.cumsum(per) - per, per)
    first = bounds[:-1][row_doc] + row_no * ROW
    length = np.minimum(size[row_doc] - row_no * ROW, ROW)
    order = np.argsort(-length, kind="stable")                 # live rows are a prefix at every step
    first, length, row_doc, row_no = first[order], length[order], row_doc[order], row_no[order]
    rows = len(first)
    live = np.searchsorted(-length, -np.arange(ROW), "left")   # rows with more than t words
    steps = int(length[0])

    def step(state: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        top = state.argmax(axis=-1)
        jump = np.take_along_axis(state, top[..., None], -1) - switch
        return np.maximum(state, jump) + e, top, state < jump

    # best score from every entry state to every state, for texts of several rows
    many = per[row_doc] > 1
    enter = np.zeros((rows, k), np.float64)
    if many.any():
        trans = np.full((rows, k, k), -np.inf)
        trans[:, np.arange(k), np.arange(k)] = 0
        which = np.flatnonzero(many)
        state = trans[which]
        counts = np.searchsorted(-length[which], -np.arange(ROW), "left")
        for t in range(steps):
            a = counts[t]
            if not a:
                break
            state[:a] = step(state[:a], scores[first[which[:a]] + t][:, None, :])[0]
        at = np.full((int(row_no.max()) + 1, len(size)), -1)
        at[row_no[which], row_doc[which]] = np.arange(len(which))
        value = np.zeros((len(size), k))
        for c in range(at.shape[0]):
            docs = np.flatnonzero(at[c] >= 0)
            r = at[c, docs]
            enter[which[r]] = value[docs]
            value[docs] = (value[docs][:, :, None] + state[r]).max(axis=1)
    # forward with back pointers
    kind = np.min_scalar_type(-k)                              # the smallest integers that hold every state
    back_top = np.zeros((steps, rows), kind)
    back_jump = np.zeros((steps, rows, k), bool)
    state = enter
    for t in range(steps):
        a = live[t]
        state[:a], back_top[t, :a], back_jump[t, :a] = step(state[:a], scores[first[:a] + t])
    # backward from every end state
    path = np.zeros((steps, rows, k), kind)
    now = np.tile(np.arange(k, dtype=kind), (rows, 1))
    for t in range(steps - 1, -1, -1):
        a = live[t]
        path[t, :a] = now[:a]
        jumped = np.take_along_axis(back_jump[t, :a], now[:a].astype(np.int64), 1)
        now[:a] = np.where(jumped, back_top[t, :a, None], now[:a])
    # end states: the last row of a text ends best, an earlier one ends where the next was entered
    end = state.argmax(axis=1)
    if many.any():
        table = np.full((int(row_no.max()) + 1, len(size)), -1)
        table[row_no, row_doc] = np.arange(rows)
        for c in range(table.shape[0] - 2, -1, -1):
            docs = np.flatnonzero(table[c + 1] >= 0)
            nxt = table[c + 1, docs]
            end[table[c, docs]] = now[nxt, end[nxt]]
    out = np.zeros(n, np.int64)
    for t in range(steps):
        a = live[t]
        out[first[:a] + t] = path[t, np.arange(a), end[:a]]
    return out


def _predict(model: Model, switch: float, spans: bool):
    memo = WordMemo(model.rows)
    langs = np.array([*model.langs, "und"], object)
    k = len(model.langs)

    def label(texts: list[bytes | None]):
        split = [(t or b"").split() for t in texts]
        words = [w for s in split for w in s]
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in split])]).astype(np.int64)
        if not k or not words:
            return split, bounds, np.zeros(len(words), np.int64), np.zeros(len(words)), np.zeros((len(words), k))
        rows = memo.rows_of(words)
        scores = rows[:, :-1].astype(np.float64)
        return split, bounds, viterbi(scores, bounds, switch), rows[:, -1].astype(np.int64), scores

    few = max(1, min(2000, 2000 * 1024 // max(k * k, 1)))     # a row's paths are k x k numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, few):
                b = whole.slice(at, few)
                texts = b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()
                split, bounds, lang, letters, scores = label(texts)
                n = len(texts)
                doc = np.repeat(np.arange(n), np.diff(bounds))
                weight = np.bincount(doc * max(k, 1) + lang, letters, n * max(k, 1)).reshape(n, max(k, 1))
                total = weight.sum(axis=1)
                best = weight.argmax(axis=1)
                sums = np.stack([np.bincount(doc, np.where(lang == best[doc], scores[:, j], 0), n)
                                 for j in range(k)], 1) if k else np.zeros((n, 1))
                odds = np.exp(np.clip(sums - sums[np.arange(n), best][:, None], -500, 500)).sum(axis=1)
                score = np.where(total > 0, weight[np.arange(n), best] / np.maximum(total, 1) / np.maximum(odds, 1), 0.0)
                silent = (total > 0) & (np.bincount(doc, np.abs(scores).sum(axis=1), n) == 0)
                best = np.where(silent, model.common, best)
                score[silent] = 0.0
                names = langs[np.where((total > 0) & (k > 0), best, k)]
                cols = [*b.columns[:-1], pa.array(names.tolist(), pa.string()), pa.array(np.clip(score, 0, 1))]
                out = [*b.schema.names[:-1], "lang_pred", "score"]
                if spans:
                    cols.append(pa.array([_spans(lang[bounds[i]: bounds[i + 1]], letters[bounds[i]: bounds[i + 1]],
                                                 model.langs) for i in range(n)],
                                         pa.list_(pa.struct([("first_word", pa.int64()), ("words", pa.int64()),
                                                             ("lang", pa.string())]))))
                    out.append("spans")
                yield pa.RecordBatch.from_arrays(cols, names=out)

    return run


def _spans(lang: np.ndarray, letters: np.ndarray, langs: list[str]) -> list[dict]:
    if not len(lang) or not len(langs) or not letters.any():
        return []
    cut = np.concatenate([[0], np.flatnonzero(np.diff(lang)) + 1, [len(lang)]])
    return [{"first_word": int(a), "words": int(b - a), "lang": langs[lang[a]]} for a, b in zip(cut[:-1], cut[1:])]


def predict(docs: DataFrame, model: Model, keep: list[Column | str], switch: float = SWITCH,
            spans: bool = False) -> DataFrame:
    """``keep`` columns plus lang_pred, score and, if asked for, the labelled word spans of each text."""
    part = docs.select(*keep, F.col("text").alias("__text"))
    schema = part.drop("__text").schema.add("lang_pred", "string").add("score", "double")
    if spans:
        span = T.StructType().add("first_word", "long").add("words", "long").add("lang", "string")
        schema = schema.add("spans", T.ArrayType(span))
    return part.mapInArrow(_predict(model, switch, spans), schema)


def language_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    prepare(docs.sparkSession)
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    model = train(docs.where(~held & F.col("lang").isNotNull()))
    return predict(docs, model, [F.col("doc_id"), held.alias("held_out")])
