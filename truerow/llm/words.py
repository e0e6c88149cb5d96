"""Words and their stable 64-bit hashes, for whole batches of texts at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash

from truerow.llm.common import ASCII_LOWER

#: Words that a task remembers; a full memory is emptied, which changes no result.
MOST_REMEMBERED = 300_000


class WordHashes(dict):
    """word -> 64-bit hash, the same in every process."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def hashed_words(texts: Sequence[bytes], memory: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, A-Z lower-cased, and how many each text has.

    Words are split at the six ASCII spaces, which is what bytes.split() does.
    """
    look_up = memory.__getitem__
    parts = [np.empty(0, np.uint64)]
    for text in texts:  # the words of one text at a time: as objects they take ten times their text
        words = text.translate(ASCII_LOWER).split()
        parts.append(np.fromiter(map(look_up, words), np.uint64, len(words)))
    return np.concatenate(parts), np.fromiter(map(len, parts[1:]), np.int64, len(texts))


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def shingle_sets(hashes: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, and how many each text has.

    A text with fewer words than `width` is one shingle, a text without words has none.
    """
    n, texts = len(hashes), len(sizes)
    ends = np.cumsum(sizes)
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    key = np.zeros(max(n - width + 1, 0), np.uint64)
    for i in range(width):
        key = mixed(key + hashes[i : i + len(key)])
    doc = np.repeat(np.arange(texts), sizes)
    whole = doc[: len(key)] == doc[width - 1 :] if len(key) else np.zeros(0, bool)
    values, owners = [key[whole]], [doc[: len(key)][whole]]
    for t in short:
        value = np.full(1, sizes[t], np.uint64)
        for h in hashes[ends[t] - sizes[t] : ends[t]]:
            value = mixed(value + h)
        values.append(value)
        owners.append(np.full(1, t))
    value, owner = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    first = np.ones(len(value), bool)
    first[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[first], np.bincount(owner[first], minlength=texts)
