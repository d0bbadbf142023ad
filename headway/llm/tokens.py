"""Token ids of whole texts with a public word-level BPE file, computed per distinct word.

The tokenizer never joins across ASCII blanks, so a text's ids are those of its blank-separated
words.  Each Python worker keeps the ids of the words it has met (a bounded memo; a word that was
dropped is simply encoded again).  A new word of plain Latin letters, with or without ASCII marks
after it, is one piece of letters and one of marks for the tokenizer's model; every other new word
goes through the whole tokenizer.
"""

from __future__ import annotations

import gc
from functools import lru_cache
from itertools import chain, repeat

import numpy as np

from headway.llm.common import lasting

MEMO_WORDS = 500_000
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"   # all ASCII marks but the apostrophe (contractions)
LAST_LEAD = 0xC8      # first UTF-8 byte of the last code points taken as plain letters (below U+0240)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# texts of nothing but Latin letters, digits, blanks, full stops and commas: marks can stand alone
_PLAIN = bytes(b for b in range(128) if chr(b).isalnum()) + b" \t\n\v\f\r.," + bytes(range(0x80, 0xC0)) + bytes(range(0xC3, 0xC9))
_JOINED = (b"..", b".,", b",.", b",,", b"\xc3\x97", b"\xc3\xb7")


def split_words(text: bytes) -> list[bytes]:
    """Parts of a text that the tokenizer treats alone: blank-separated words and, where every full stop
    and comma follows a letter, a digit or a blank, these marks by themselves (far fewer distinct words)."""
    if text.translate(None, _PLAIN) or any(j in text for j in _JOINED):
        return text.split()
    return text.lower().replace(b",", b" , ").replace(b".", b" . ").split()


class WordEncoder:
    """Ids of texts as one flat vector; ``end`` closes every text with id 0."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.reset()

    def reset(self) -> None:
        self.code: dict[bytes, int] = {}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.pool = np.zeros(1 << 16, np.int32)
        self.used = 1                                  # entry 0: the closing id 0
        self.first = np.zeros(1 << 16, np.int64)
        self.n = np.zeros(1 << 16, np.int64)
        self.n[0] = 1
        self.entries = 1

    def _add(self, words: list[bytes], ids: tuple[np.ndarray, np.ndarray]) -> None:
        flat, sizes = ids
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.entries + len(words) > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.n = np.concatenate([self.n, np.zeros_like(self.n)])
        self.pool[self.used: self.used + len(flat)] = flat
        a, b = self.entries, self.entries + len(words)
        self.n[a:b] = sizes
        self.first[a:b] = self.used + np.cumsum(sizes) - sizes
        self.code.update(zip(words, range(a, b)))
        self.used += len(flat)
        self.entries = b

    def _piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece that the tokenizer would not split or change any more."""
        ids = self.pieces.get(piece)
        if ids is None:
            ids = tuple([t.id for t in self.model.tokenize(piece)])
            self.pieces[piece] = ids
        return ids

    def _learn(self, words: list[bytes]) -> None:
        got: list[tuple[int, ...] | None] = []
        odd: list[int] = []
        for i, w in enumerate(words):
            stem = w.rstrip(MARKS)
            if not stem:
                got.append(self._piece(w.decode()))
                continue
            if max(stem) <= LAST_LEAD:
                letters = stem.decode("utf-8", "replace").lower()
                if letters.isalpha():
                    # the byte-level alphabet of the vocabulary: Latin-1 view of the UTF-8 bytes
                    ids = self._piece(letters if stem.isascii() else _byte_level(letters))
                    if len(stem) < len(w):
                        ids = ids + self._piece(w[len(stem):].decode())
                    got.append(ids)
                    continue
            got.append(None)
            odd.append(i)
        if odd:
            texts = [words[i].decode("utf-8", "replace") for i in odd]
            for i, e in zip(odd, self.tok.encode_batch(texts, add_special_tokens=False)):
                got[i] = tuple(e.ids)
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter(chain.from_iterable(got), np.int32, int(sizes.sum()))
        self._add(words, (flat, sizes))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the n + 1 bounds of the texts, each closed by id 0."""
        collects = gc.isenabled()
        gc.disable()                                   # many small objects, no cycles
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.entries > MEMO_WORDS:
            self.reset()
        split = [split_words(t) for t in texts]
        words = [w for part in split for w in part]
        codes = np.fromiter(map(self.code.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(codes < 0)
        if len(new):
            fresh = [words[i] for i in new.tolist()]
            self._learn(list(dict.fromkeys(fresh)))
            codes[new] = np.fromiter(map(self.code.__getitem__, fresh), np.int64, len(fresh))
        per = np.array([len(p) for p in split], np.int64)
        ends = np.cumsum(per)
        codes = np.insert(codes, ends, 0)
        sizes = self.n[codes]
        upto = np.cumsum(sizes)
        at = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - sizes, sizes)
        flat = self.pool[np.repeat(self.first[codes], sizes) + at]
        bounds = np.concatenate([[0], upto[ends + np.arange(len(ends))]]) if len(texts) else np.zeros(1, np.int64)
        return flat, bounds


@lru_cache(1)
def _byte_letters() -> dict[int, int]:
    """Bytes of letters to the printable code points that stand for them in byte-level vocabularies:
    printable Latin-1 stays, the others follow from U+0100 in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: 0x100 + i for i, b in enumerate(hidden)}


def _byte_level(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(_byte_letters())


@lru_cache(2)
def encoder(path: str) -> WordEncoder:
    return lasting(WordEncoder(path))
