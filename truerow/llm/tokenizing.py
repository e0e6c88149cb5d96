"""Token ids of whole texts by a public tokenizer whose merges never cross white space."""

from __future__ import annotations

from array import array
from collections.abc import Sequence

import numpy as np

from truerow.llm.common import ASCII_LOWER

#: Chunks that a worker remembers; a full memory is emptied, which changes no result.
MOST_REMEMBERED = 600_000
_LETTERS, _MARKS = frozenset(b"abcdefghijklmnopqrstuvwxyz"), frozenset(b".,")
#: How special tokens begin: they are matched before lower-casing, so such texts go in whole.
_SPECIAL = b"<|"


def vocabulary_path(name: str) -> str:
    """The file of a public vocabulary installed beside Spark on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkIds(dict):
    """chunk between ASCII spaces -> position in `starts` and `sizes` of its ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        # Where a word of a-z reaches the merges as it is, they can be applied to it directly.
        word = "abcxyz"
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(word))
        self.plain = [c for c, _ in cut] == [word]
        self.model = self.tokenizer.model
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.ids, self.starts, self.sizes = array("I"), array("q"), array("q")

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]

    def __missing__(self, chunk: bytes) -> int:
        if len(chunk) > 1 and chunk[-1] in _MARKS and chunk[-2] in _LETTERS:
            # A point or comma after a word's last letter is a token apart.
            ids = self._of(chunk[:-1]) + self._of(chunk[-1:])
        elif self.plain and chunk.isalpha():  # of bytes: a-z only
            ids = [token.id for token in self.model.tokenize(chunk.decode())]
        else:
            ids = self.encode([chunk.decode()])[0]
        self[chunk] = code = len(self.starts)
        self.starts.append(len(self.ids))
        self.sizes.append(len(ids))
        self.ids.extend(ids)
        return code

    def _of(self, chunk: bytes) -> array:
        code = self[chunk]
        return self.ids[self.starts[code] : self.starts[code] + self.sizes[code]]

    def ids_of(self, texts: Sequence[bytes], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids (uint32) of all texts, one after the other, and how many each has.

        `end`, if given, follows the ids of each text.
        """
        if len(self) > MOST_REMEMBERED:
            self.forget()
        special = {i: self.encode([t.decode()])[0] for i, t in enumerate(texts) if _SPECIAL in t}
        chunks = [[] if i in special else t.translate(ASCII_LOWER).split() for i, t in enumerate(texts)]
        codes = np.concatenate(
            [np.fromiter(map(self.__getitem__, own), np.int64, len(own)) for own in chunks] or [np.empty(0, np.int64)]
        )
        starts, sizes = np.frombuffer(self.starts, np.int64), np.frombuffer(self.sizes, np.int64)
        long = sizes[codes]
        before = np.cumsum(long) - long
        flat = np.frombuffer(self.ids, np.uint32)
        ids = flat[np.repeat(starts[codes] - before, long) + np.arange(int(long.sum()))] if len(codes) else flat[:0]
        bounds = np.concatenate([[0], np.cumsum(long)])
        ends = np.cumsum([len(own) for own in chunks]).astype(np.int64) if chunks else np.empty(0, np.int64)
        counts = np.diff(np.concatenate([[0], bounds[ends]])) if chunks else ends
        if not special and end is None:
            return ids, counts
        pieces, at = [], 0
        tail = [] if end is None else [np.array([end], np.uint32)]
        for i, n in enumerate(counts):
            pieces.append(np.array(special[i], np.uint32) if i in special else ids[at : at + n])
            pieces += tail
            at += n
        sizes = np.array([len(special[i]) if i in special else n for i, n in enumerate(counts)], np.int64)
        whole = np.concatenate(pieces) if pieces else ids
        return whole, sizes + (end is not None)


_KNOWN: dict[str, ChunkIds] = {}


def known_chunks(path: str) -> ChunkIds:
    """The worker's memory for a vocabulary; tasks that follow each other go on with it."""
    if path not in _KNOWN:
        _KNOWN[path] = ChunkIds(path)
    return _KNOWN[path]
