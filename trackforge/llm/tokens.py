"""Token ids of texts, word by word, equal to what the tokenizer file gives for the whole text."""

from __future__ import annotations

import os
import re
from functools import cache
from itertools import chain, repeat

import numpy as np
from tokenizers import Tokenizer

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the cores already

#: The tokenizer file's words, for lower-case texts of the characters that _UNUSUAL leaves.
_LETTERS = "a-zªµºß-öø-įı-ž"
_WORDS = re.compile(rf"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[0-9²³¹¼½¾]|[^\s{_LETTERS}0-9²³¹¼½¾]+")
#: A text with any other character, or with what may be a special token, is left to the tokenizer as a whole.
_UNUSUAL = re.compile("[^\t\n\r -~\xa1-\xac\xae-įı-ž‐-‧€]|<\\|")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """``encode`` with a memory of words.

    The tokenizer splits normalised text into words and encodes each word by
    itself, so a word always has the same ids; most words of a text are known.
    ``max_words`` bounds the memory: when it is full, the words that were met
    only once are forgotten, and more if they do not make half of it free.
    """

    def __init__(self, path: str | None = None, max_words: int = 250_000) -> None:
        self.tokenizer, self.max_words = Tokenizer.from_file(path or default_path()), max_words
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.length, self.met = (np.zeros(1 << 14, np.int64) for _ in range(3))

    def forget(self) -> None:
        """Keep the words that were met most, at most half of the memory."""
        n, words = len(self.index), list(self.index)
        met = self.met[:n].copy()
        least = max(2, int(np.partition(met, n - self.max_words // 2)[n - self.max_words // 2]) + 1)
        kept = np.flatnonzero(met >= least)
        start, length, ids = self.start[kept], self.length[kept], self.ids
        self.clear()
        ends = np.cumsum(length)
        self._append([words[i] for i in kept.tolist()], length, ids[np.repeat(start - ends + length, length) + np.arange(int(length.sum()))])

    def learn(self, words: list[str]) -> None:
        """Encode unknown words, all at once (the last id of each word says so), and append them to the memory."""
        found = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, np.uint32)
        length = np.diff(np.flatnonzero(self.ends[found]) + 1, prepend=0)
        if len(length) != len(words):
            raise ValueError("the tokenizer splits a word")
        self._append(words, length, found)

    def _append(self, words: list[str], length: np.ndarray, ids: np.ndarray) -> None:
        n, total = len(self.index), len(ids)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(words) > len(self.start):
            self.start, self.length, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length, self.met))
        self.ids[self.used : self.used + total] = ids
        self.start[n : n + len(words)], self.length[n : n + len(words)] = self.used + np.cumsum(length) - length, length
        self.used += total
        self.index.update(zip(words, range(n, n + len(words))))

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; the texts' unknown words are learnt together."""
        usual = [i for i, t in enumerate(texts) if not _UNUSUAL.search(t)]
        split = [_WORDS.findall(texts[i].lower()) for i in usual]
        if len(self.index) > self.max_words:
            self.forget()
        words = list(chain.from_iterable(split))
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            unknown = [words[i] for i in missing.tolist()]
            self.learn(list(dict.fromkeys(unknown)))
            at[missing] = np.fromiter(map(self.index.__getitem__, unknown), np.int64, len(unknown))
        self.met[: len(self.index)] += np.bincount(at, minlength=len(self.index))
        length = self.length[at]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(words) else 0
        ids = self.ids[np.repeat(self.start[at] - ends + length, length) + np.arange(total)]
        last = np.concatenate([[0], ends])[np.cumsum([0, *map(len, split)])]
        found = dict(zip(usual, np.split(ids, last[1:-1]))) if usual else {}
        return [found[i] if i in found else np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for i, t in enumerate(texts)]


@cache
def shared_encoder(path: str | None = None) -> WordEncoder:
    """One encoder for all tasks of a Python worker, which so knows ever more words."""
    return WordEncoder(path)
