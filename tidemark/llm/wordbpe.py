"""Token ids of many texts for a word-level BPE file: each distinct word is encoded once per worker and then looked up.

White space is dropped by the tokenizer and ends a word, so a text's ids are those of its space-free chunks in a row. New
words of letters only are merged many at a time with the file's merge table; every other chunk, and every text that may hold a special token,
goes through the library.
"""

from __future__ import annotations

import json
import os

import numpy as np

_STOPS = b".,;:!?"
CACHE_WORDS = 400_000  # entries held by a worker; only a cache, so emptying it changes no result


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordTokenizer:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.last = np.array([vocab[c + end] for c in letters], dtype=np.int64)
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.none = len(pairs)
        self.cache: dict[bytes, bytes] = {}

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def _merge_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words: in rounds, the first pair of least rank of every word is merged, until no pair has a rank."""
        size = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbol = self.inner[data]
        ends = np.cumsum(size)
        symbol[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), size)
        rank = np.full(len(symbol), self.none)
        rank[:-1] = self._rank(symbol[:-1], symbol[1:])
        rank[ends - 1] = self.none
        done_symbol, done_word = [], []
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.r_[starts, len(word)])
            open_word = np.repeat(least < self.none, counts)
            if not open_word.all():
                done_symbol.append(symbol[~open_word])
                done_word.append(word[~open_word])
                symbol, word, rank = symbol[open_word], word[open_word], rank[open_word]
                counts, least = counts[least < self.none], least[least < self.none]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(least, counts))
            at = at[np.r_[True, word[at[1:]] != word[at[:-1]]]]  # the first of each word
            symbol[at] = self.merged[least]
            keep = np.ones(len(symbol), dtype=bool)
            keep[at + 1] = False
            left = at - np.arange(len(at))  # place of the merged symbols after the others have moved up
            symbol, word = symbol[keep], word[keep]
            rank = rank[keep]
            touched = np.concatenate([left, left[left > 0] - 1])
            nxt = np.minimum(touched + 1, len(symbol) - 1)
            inside = (touched + 1 < len(symbol)) & (word[nxt] == word[touched])
            rank[touched] = np.where(inside, self._rank(symbol[touched], symbol[nxt]), self.none)
        symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
        symbol = symbol[np.argsort(word, kind="stable")].astype("<u4").tobytes()
        cut = np.r_[0, np.cumsum(np.bincount(word, minlength=len(words)))] * 4
        return [symbol[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def _library_ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, chunks: set[bytes]) -> None:
        """Puts the ids of new chunks into the cache."""
        cut, words, others = {}, set(), []
        for chunk in chunks:
            core = chunk.rstrip(_STOPS)
            # letters of A-Z and of the Latin-1 block are letters to the tokenizer and already composed
            if core.isalpha() or (core and core.decode("utf-8").isalpha() and max(core.decode("utf-8")) < "ƀ"):
                if core.isascii() or core.decode("utf-8").islower():
                    cut[chunk] = core, chunk[len(core) :]
                    words.add(core)
                    continue
            others.append(chunk)
        words = [w for w in words if w not in self.cache]
        if words:
            self.cache.update(zip(words, self._merge_words(words)))
        stops = [s for s in {s for _, s in cut.values()} if s not in self.cache and s]
        others = [o for o in others if o not in self.cache] + stops
        if others:
            self.cache.update(zip(others, self._library_ids([o.decode("utf-8") for o in others])))
        for chunk, (core, stop) in cut.items():
            if stop:
                self.cache[chunk] = self.cache[core] + self.cache[stop]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        plain = [None if b"<|" in t else t.lower().split() for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        new = set()
        for chunks in plain:
            if chunks:
                new.update(chunks)
        new = new.difference(self.cache)
        if new:
            self._learn(new)
        found = self.cache.__getitem__
        out = [b"".join(map(found, c)) if c is not None else b"" for c in plain]
        special = [i for i, c in enumerate(plain) if c is None]
        if special:
            for i, ids in zip(special, self._library_ids([texts[i].decode("utf-8") for i in special])):
                out[i] = ids
        return out


_held: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per worker process and file."""
    if path not in _held:
        _held[path] = WordTokenizer(path)
    return _held[path]
