"""Quality rules as weak supervision.

Each rule votes keep, reject or abstains.  Votes of a document form a small code (base three, one
digit per rule), so the whole corpus is summarised by the number of documents per code: at most
3^rules rows, whatever its size.  Expectation maximisation on that table estimates how often each
rule is right about good and about bad documents, and every document is kept if its posterior
probability of being good is at least ``threshold``.  A document that fails the base checks (fewer
than 50 words, or more than half of the words inside repeated three-word windows) is never kept.

Defined cases: null or blank text has no words, so it fails the base; rows are judged one by one, so
repeated rows get equal verdicts; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import prepare, release_memos, rows_of, stored, unpack

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
WINDOW = 3
KEEP, REJECT, ABSTAIN = 2, 1, 0
THRESHOLD = 0.5
# fixed values: frequent function words of the corpus languages
FUNCTION_WORDS = frozenset((
    b"the of and to in a is that it for on was with as at by this from are be or not "
    b"de la le et les des en un une du que qui dans est pour pas au "
    b"el los las y es por con para se del al su lo como "
    b"der die das und zu den von mit ist ein eine im sich auf nicht dem auch").split())
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_letters", "n_function", "n_marks", "n_symbol_words")


def repeat_words(words: list[bytes]) -> int:
    """Words inside a three-word window that occurs at least twice in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    k = len(seen)
    if k < (1 << 20):
        grams = (ids[:-2] * k + ids[1:-1]) * k + ids[2:]
    else:
        two = np.unique(ids[:-1] * k + ids[1:], return_inverse=True)[1]
        grams = two[:-1] * k + ids[2:]
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    twice = np.concatenate([order[1:][same], order[:-1][same]])
    for d in range(WINDOW):
        hit[twice + d] = True
    return int(hit.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """Figures of one UTF-8 text, in the order of MEASURES + EXTRA."""
    words = text.split()
    n = len(words)
    chars = sum(map(len, words))
    symbols = sum(text.count(SYMBOLS[i: i + 1]) for i in range(len(SYMBOLS)))
    lines, dup, seen = 0, 0, set()
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    if text.isascii():
        letters = len(text.translate(None, _NOT_LETTERS))
        upper = len(text.translate(None, _NOT_UPPER))
    else:
        raw = np.frombuffer(text, np.uint8)
        chars -= int(((raw & 0xC0) == 0x80).sum())
        body = text.decode("utf-8", "replace")
        letters = sum(map(str.isalpha, body))
        upper = sum(map(str.isupper, body))
    marks = text.count(b"!")
    function = sum(1 for w in words if w.lower() in FUNCTION_WORDS) if n else 0
    marked = sum(1 for w in words if len(w.translate(None, SYMBOLS)) < len(w)) if symbols else 0
    return n, chars, symbols, dup, repeat_words(words), lines, upper, letters, function, marks, marked


_NOT_LETTERS = bytes(b for b in range(256) if not chr(b).isalpha() or b > 127)
_NOT_UPPER = bytes(b for b in range(256) if not (65 <= b <= 90))


def measures(docs: DataFrame, keep: list[Column | str]) -> DataFrame:
    part = docs.select(*keep, F.col("text").alias("__text"))
    schema = part.drop("__text").schema
    for c in MEASURES + EXTRA:
        schema = schema.add(c, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memos()
        for b in batches:
            yield _measured(b.columns[:-1], b.schema.names[:-1], b.column(b.num_columns - 1))

    return part.mapInArrow(run, schema)


def measured_rows(docs: DataFrame) -> DataFrame:
    """Whole rows as ``__row`` plus their figures; the text crosses to Python once, inside its row."""
    part = docs.select(rows_of(docs))
    schema = T.StructType(list(part.schema.fields))
    for c in MEASURES + EXTRA:
        schema = schema.add(c, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memos()
        for b in batches:
            yield _measured(b.columns, b.schema.names, b.column(0).field("text"))

    return part.mapInArrow(run, schema)


def _measured(columns: list[pa.Array], names: list[str], texts: pa.Array) -> pa.RecordBatch:
    got = np.empty((len(texts), len(MEASURES + EXTRA)), np.int64)
    for i, t in enumerate(texts):
        body = t.as_py()
        got[i] = measure(body.encode("utf-8", "replace") if body else b"")
    return pa.RecordBatch.from_arrays([*columns, *(pa.array(got[:, i].copy()) for i in range(got.shape[1]))],
                                      names=[*names, *MEASURES, *EXTRA])


# ---------------------------------------------------------------- rules

def _vote(reject: Column, keep: Column) -> Column:
    return F.when(reject, REJECT).when(keep, KEEP).otherwise(ABSTAIN)


def rules() -> dict[str, Column]:
    """Votes by name; every rule abstains between its two limits and on texts without words."""
    words, lines = F.col("n_words"), F.col("n_lines")
    per_word = lambda c: F.col(c) / F.greatest(words, F.lit(1))
    some = words > 0
    return {
        "symbols": _vote(some & (per_word("n_symbols") > 0.3), some & (per_word("n_symbols") < 0.05)),
        "symbol_words": _vote(some & (per_word("n_symbol_words") > 0.3), some & (per_word("n_symbol_words") < 0.05)),
        "repeats": _vote(some & (per_word("n_repeat_words") > 0.3), some & (per_word("n_repeat_words") < 0.1)),
        "lines": _vote(F.col("n_dup_lines") > 0.3 * lines, (lines >= 3) & (F.col("n_dup_lines") <= 0.05 * lines)),
        "length": _vote(words < MIN_WORDS, words >= 2 * MIN_WORDS),
        "word_size": _vote(some & ~per_word("word_chars").between(2.5, 12.0), per_word("word_chars").between(3.5, 9.0)),
        "case": _vote(some & (F.col("n_upper") > 0.5 * F.col("n_letters")),
                      some & (F.col("n_upper") < 0.15 * F.col("n_letters"))),
        "function_words": _vote((words >= MIN_WORDS) & (per_word("n_function") < 0.01),
                                some & (per_word("n_function") > 0.05)),
        "shouting": _vote(some & (per_word("n_marks") > 0.2), some & (per_word("n_marks") < 0.02)),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vote_code() -> Column:
    out = F.lit(0)
    for v in rules().values():
        out = out * 3 + v
    return out.cast("int")


# ---------------------------------------------------------------- label model

def posteriors(codes: np.ndarray, counts: np.ndarray, n_rules: int, rounds: int = 200) -> np.ndarray:
    """Probability of a good document per vote code, by expectation maximisation.

    A rule that votes is right with its own probability on good and on bad documents.  The start and the
    prior say what such rules are like: a reject is rare on good documents (Beta(99, 1)), a keep says
    little, for bad documents are bad in one way or another (Beta(2, 8)); abstentions tell nothing.
    """
    if not len(codes):
        return np.zeros(0)
    votes = np.stack([codes // 3 ** (n_rules - 1 - i) % 3 for i in range(n_rules)], axis=1)
    keep, reject = votes == KEEP, votes == REJECT
    right = np.repeat([[0.99], [0.2]], n_rules, axis=1)         # on good, on bad documents
    prior = 0.8
    good = np.full(len(codes), prior)
    for _ in range(rounds):
        on_good = keep @ np.log(right[0]) + reject @ np.log1p(-right[0])
        on_bad = reject @ np.log(right[1]) + keep @ np.log1p(-right[1])
        new = 1 / (1 + np.exp(np.clip(on_bad - on_good + np.log1p(-prior) - np.log(prior), -500, 500)))
        w_good, w_bad = new * counts, (1 - new) * counts
        prior = float(np.clip((w_good.sum() + 8) / (counts.sum() + 10), 0.01, 0.99))
        cast = (keep | reject).astype(float)
        right = np.stack([(w_good @ keep + 99) / (w_good @ cast + 100), (w_bad @ reject + 2) / (w_bad @ cast + 10)])
        right = np.clip(right, 1e-4, 1 - 1e-4)
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    return good


def judged(measured: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``measured`` (stored) plus base_failed, quality (posterior) and kept."""
    voted = measured.withColumn("votes", vote_code())
    table = voted.groupBy("votes").count().collect()            # at most 3^rules rows
    codes = np.array([r["votes"] for r in table], np.int64)
    order = np.argsort(codes)
    good = posteriors(codes[order], np.array([r["count"] for r in table], float)[order], len(rules()))
    spark = measured.sparkSession
    lookup = spark.createDataFrame([(int(c), float(g)) for c, g in zip(codes[order], good)],
                                   "votes int, quality double")
    return (voted.join(F.broadcast(lookup), "votes").drop("votes")   # one row per vote code
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)))


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base figures, base_failed, kept and the posterior quality."""
    prepare(docs.sparkSession)
    return judged(stored(measures(docs, ["doc_id"]), "rules")).select(
        "doc_id", *MEASURES, "base_failed", "kept", "quality")


def filter_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents table without the rejected rows."""
    prepare(docs.sparkSession)
    kept = judged(stored(measured_rows(docs), "rules-stage"), threshold).where("kept")
    return unpack(kept, docs.columns)
