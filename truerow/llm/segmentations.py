"""SentencePiece encoding by sampled segmentations without replacement, and decoding (operator 2).

All segmentations of a text form a lattice. Gumbel noise on every path, realised top-down, makes
the k largest perturbed paths a sample of k distinct segmentations without replacement. A
best-first search splits what is left of the lattice after each found path into the sets of
paths that leave it at one piece, and bounds each set by its own truncated Gumbel.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.llm.common import split_documents, table, texts_of
from truerow.llm.tokenizing import vocabulary_path
from truerow.llm.words import mixed

VOCABULARY = "piece_bpe_32k.model"
#: Distinct segmentations per document.
SAMPLES = 2
#: A piece of rank r in the vocabulary has weight (r + 2) ** -SHARPNESS, after Zipf.
SHARPNESS = 1.0
SPACE, NO_CHARACTER = 0x2581, 0x110000
#: No uniform number here gives a Gumbel variable above this: -log(-log(1 - 2**-54)).
MOST_GUMBEL = 37.5
_SLOTS = np.uint64((1 << 22) - 1)

_BASE = np.uint64(0xD1B54A32D192ED03)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


class Vocabulary:
    """Pieces by the hash of their characters, with the hashes of all their beginnings."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        usual = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        pieces = [np.array([ord(c) for c in model.id_to_piece(i)], np.uint64) for i in usual]
        byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(n) if model.is_byte(i)}
        self.byte_ids = np.array([byte_ids[b] for b in range(256)], np.int64)
        self.longest = max(map(len, pieces))
        score = np.array([model.get_score(i) for i in usual])
        rank = np.where(score < -1e6, n, -score)  # unused single pieces come last
        self.weight = np.full(n, -np.inf)
        self.weight[usual] = -SHARPNESS * np.log(rank + 2)
        self.byte_weight = -SHARPNESS * np.log(n + 2.0)
        found: dict[int, int] = {}
        inner = np.zeros(1 << 16, bool)
        for i, piece in zip(usual, pieces):
            value = np.zeros(1, np.uint64)
            for c in piece:
                value = self.extend(value, c)
                found.setdefault(int(value[0]), -1)
            found[int(value[0])] = i
            if len(piece) > 1:
                inner[piece[piece < 1 << 16].astype(int)] = True
        self.inner = inner
        keys = np.array(list(found), np.uint64)
        order = np.argsort(keys)
        self.keys, self.piece = keys[order], np.array(list(found.values()))[order]
        # One slot per low bits of a key; where several keys share one, a binary search decides.
        slots = (self.keys & _SLOTS).astype(np.int64)
        self.slot = np.zeros(int(_SLOTS) + 1, np.int32)
        self.slot[slots] = np.arange(len(slots))
        self.shared = np.bincount(slots, minlength=len(self.slot)) > 1
        self.text = [b""] * n
        for i in usual:
            self.text[i] = model.id_to_piece(i).replace("▁", " ").encode()
        for b, i in byte_ids.items():
            self.text[i] = bytes([b])

    @staticmethod
    def extend(value: np.ndarray, character: np.ndarray) -> np.ndarray:
        value = (value ^ (np.asarray(character, np.uint64) + np.uint64(1))) * _BASE
        return value ^ (value >> np.uint64(31))

    def find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether some piece begins with the hashed characters, and the piece that they are or -1."""
        slot = (value & _SLOTS).astype(np.int64)
        place = self.slot[slot]
        known = self.keys[place] == value
        again = np.flatnonzero(~known & self.shared[slot])
        if len(again):
            place[again] = np.minimum(np.searchsorted(self.keys, value[again]), len(self.keys) - 1)
            known[again] = self.keys[place[again]] == value[again]
        return known, np.where(known, self.piece[place], -1)

    def decode(self, ids) -> str:
        """The text of the ids; the space put before each text is taken off again."""
        return b"".join([self.text[i] for i in ids])[1:].decode("utf-8", "replace")


_KNOWN: dict[str, Vocabulary] = {}


def known_vocabulary(path: str) -> Vocabulary:
    """Read once per worker."""
    if path not in _KNOWN:
        _KNOWN[path] = Vocabulary(path)
    return _KNOWN[path]


def characters(text: str) -> np.ndarray:
    """The code points as the lattice sees them: a space in front, spaces as the space sign. A
    space sign of the text itself is spelt in bytes, so that decoding gives it back."""
    if not text:
        return np.empty(0, np.uint32)
    own = np.frombuffer((" " + text).encode("utf-32-le"), np.uint32).copy()
    own[own == SPACE] = NO_CHARACTER
    own[own == 32] = SPACE
    return own


@dataclass
class Lattices:
    """The lattices of all different units of a batch; nodes lie between characters.

    Rows are nodes, columns the lengths of the piece that starts there.
    """

    piece: np.ndarray  # id, -1 for a character spelt in bytes, -2 for none
    log_p: np.ndarray  # of the piece, given the node, under the exact path distribution
    upto: np.ndarray  # cumulated probabilities
    likeliest: np.ndarray  # the length of the node's likeliest piece
    others: np.ndarray  # the probability of all its other pieces, exact where it is tiny
    last: np.ndarray  # whether the node ends its unit
    character: np.ndarray


def lattices(vocabulary: Vocabulary, text: np.ndarray, sizes: np.ndarray) -> Lattices:
    """`text` holds the units' characters end to end."""
    n, units = len(text), len(sizes)
    unit = np.repeat(np.arange(units), sizes)
    node = np.arange(n) + unit
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)  # characters to the unit's end
    value, at, hits = np.zeros(n, np.uint64), np.arange(n), []
    for length in range(vocabulary.longest):
        value = vocabulary.extend(value, text[at + length])
        known, found = vocabulary.find(value)
        hit = np.flatnonzero(found >= 0)
        hits.append((node[at[hit]], found[hit]))
        going = known & (left[at] > length + 1)
        at, value = at[going], value[going]
        if not len(at):
            break
    longest = max([length for length, (own, _) in enumerate(hits, 1) if len(own)], default=1)
    piece = np.full((n + units, longest), -2, np.int32)
    weight = np.full((n + units, longest), -np.inf, np.float32)
    for length, (own, found) in enumerate(hits[:longest]):
        piece[own, length] = found
        weight[own, length] = vocabulary.weight[found]
    character = np.zeros(n + units, np.uint32)
    character[node] = text
    spelt = node[piece[node, 0] == -2]
    piece[spelt, 0] = -1
    weight[spelt, 0] = vocabulary.byte_weight * utf8_length(character[spelt])
    # Sums over all ways to the unit's end, from the last characters to the first.
    total = np.zeros(n + units)
    order = np.argsort(left, kind="stable")
    bounds = np.searchsorted(left[order], np.arange(1, (left.max() if n else 0) + 2))
    log_p = weight  # overwritten node by node
    upto = np.ones((n + units, longest), np.float32)
    likeliest, others = np.zeros(n + units, np.int64), np.zeros(n + units)
    for distance, (low, high) in enumerate(zip(bounds[:-1], bounds[1:]), 1):
        own = node[order[low:high]]
        reach = min(distance, longest)
        ways = weight[own, :reach] + total[own[:, None] + np.arange(1, reach + 1)]
        best = ways.max(axis=1)
        chance = np.exp(ways - best[:, None])
        whole = chance.sum(axis=1)
        total[own] = best + np.log(whole)
        log_p[own, :reach] = ways - total[own, None]
        chance /= whole[:, None]
        upto[own, :reach] = np.cumsum(chance, axis=1)
        likeliest[own] = top = chance.argmax(axis=1)
        chance[np.arange(len(own)), top] = 0
        others[own] = chance.sum(axis=1)
    last = np.ones(n + units, bool)
    last[node] = False
    return Lattices(piece, log_p, upto, likeliest, others, last, character)


def utf8_length(character: np.ndarray) -> np.ndarray:
    character = np.where(character == NO_CHARACTER, SPACE, character)
    return 1 + (character > 0x7F) + (character > 0x7FF).astype(int) + (character > 0xFFFF)


def uniform(key: np.ndarray, counter: np.ndarray, purpose: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on row key, place and purpose only."""
    key = np.atleast_1d(key) + np.array([purpose], np.uint64) * _BASE
    bits = mixed(mixed(key) + counter.astype(np.uint64) * _INVERSE)
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def walk(lattice: Lattices, start: np.ndarray, key: np.ndarray, counter: np.ndarray, purpose: int):
    """Sample a way from each start node to its unit's end, all at once.

    Gives the nodes and piece lengths of the ways end to end, and how many pieces each has.
    """
    steps = []
    active, node = np.arange(len(start)), start
    count = np.zeros(len(start), np.int64)
    longest = lattice.upto.shape[1]
    while len(active):
        u = uniform(key[active], counter[active] + (len(steps) << 40), purpose)
        upto = lattice.upto[node]
        length = (upto < np.minimum(u, upto[:, -1] * (1 - 1e-7))[:, None]).sum(axis=1)
        length = possible(lattice, node, np.minimum(length, longest - 1))
        steps.append((active, node, length))
        count[active] += 1
        node = node + length + 1
        going = ~lattice.last[node]
        active, node = active[going], node[going]
    offset = np.cumsum(count) - count
    nodes, lengths = np.empty(int(count.sum()), np.int64), np.empty(int(count.sum()), np.int64)
    for step, (who, node, length) in enumerate(steps):
        nodes[offset[who] + step], lengths[offset[who] + step] = node, length
    return nodes, lengths, count


def possible(lattice: Lattices, node: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The lengths, but where rounding led to a piece that does not exist, the node's likeliest."""
    wrong = np.flatnonzero(lattice.piece[node, length] == -2)
    if len(wrong):
        length[wrong] = lattice.likeliest[node[wrong]]
    return length


def _gumbel_below(location: np.ndarray, top: float, u: np.ndarray) -> np.ndarray:
    """Gumbel variables at the locations, given that they are at most `top`."""
    with np.errstate(divide="ignore", over="ignore"):
        return location - np.logaddexp(location - top, np.log(-np.log(u)))


class Search:
    """Best-first search over one document's lattice for its k largest perturbed paths."""

    def __init__(self, lattice: Lattices, key: np.uint64, k: int):
        self.lattice, self.key, self.k = lattice, key, k
        self.paths: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.values: list[float] = []
        # minus the bound, path, piece, lengths that are taken, log mass of the rest
        self.queue: list[tuple[float, int, int, tuple[int, ...]]] = []

    def add(self, nodes, lengths, unit, log_p, value: float, parted: int, taken: tuple[int, ...]) -> None:
        """A found path that parts from its parent at piece `parted`, where `taken` were out.

        Sets far down the path have next to no mass. Once no uniform number could lift the rest
        above the k + 1 best bounds, they are not drawn.
        """
        number = len(self.paths)
        self.paths.append((nodes, lengths, unit, log_p))
        self.values.append(value)
        best: list[tuple[float, int]] = []
        before, low, high = 0.0, 0, 384
        while low < len(nodes):
            own = log_p[low:high].astype(np.float64)
            ahead = before + np.cumsum(own)
            with np.errstate(divide="ignore"):
                part = nodes[low:high]
                sure = self.lattice.likeliest[part] == lengths[low:high]
                rest = np.where(sure, self.lattice.others[part], -np.expm1(np.minimum(own, 0)))
                if taken and low <= parted < high:
                    out = np.array([[*taken, int(lengths[parted])]])
                    rest[parted - low] = self.mass_without(nodes[parted : parted + 1], out)[0]
                location = ahead - own + np.log(rest)
            if low < parted:
                location[: parted - low] = -np.inf
            u = uniform(self.key, np.arange(low, low + len(own)), 16 * number + 1)
            bound = _gumbel_below(location, value, u)
            top = range(len(own)) if len(own) <= self.k + 1 else np.argpartition(bound, -self.k - 1)[-self.k - 1 :].tolist()
            best = sorted(best + [(float(bound[j]), low + j) for j in top if bound[j] > -np.inf], reverse=True)
            del best[self.k + 1 :]
            before = float(ahead[-1])
            if high > parted and len(best) > self.k and before + MOST_GUMBEL < best[-1][0]:
                break
            low, high = high, 2 * high
        for bound_, j in best:
            out = (int(lengths[j]),) + (taken if j == parted else ())
            heapq.heappush(self.queue, (-bound_, number, j, out))

    def mass_without(self, nodes: np.ndarray, out: np.ndarray) -> np.ndarray:
        """The probability of all pieces at each node but those of the lengths in its row of `out`."""
        p = np.exp(self.lattice.log_p[nodes].astype(np.float64))
        np.put_along_axis(p, out, 0, axis=1)
        return p.sum(axis=1)

    def part(self) -> tuple[float, int, int, int, tuple[int, ...]] | None:
        """Take the best set left: its bound, path, piece, the length chosen there, lengths out."""
        if not self.queue:
            return None
        bound, number, j, out = heapq.heappop(self.queue)
        node = self.paths[number][0][j]
        p = np.exp(self.lattice.log_p[node].astype(float))
        p[list(out)] = 0
        if p.sum() <= 0:
            return self.part()
        u = uniform(self.key, np.array([len(self.paths)]), 16 * len(self.paths) + 2)[0]
        length = min(int(np.searchsorted(np.cumsum(p), u * p.sum())), len(p) - 1)
        return -bound, number, j, length, out


def log_inclusion(log_p: float, threshold: float) -> float:
    """log of the chance that a path of this probability is above the threshold."""
    if threshold == -np.inf:
        return 0.0
    x = log_p - threshold
    return float(np.log(-np.expm1(-np.exp(x)))) if x > -30 else float(x)


def sample(vocabulary: Vocabulary, texts: list[str], keys: np.ndarray, k: int) -> list[list[dict]]:
    """Per text its k distinct segmentations (fewer if it has fewer), best perturbed value first."""
    parts = [characters(t) for t in texts]
    docs = len(parts)
    sizes = np.array([len(p) for p in parts], np.int64)
    text = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    n = len(text)
    # Units: no piece reaches from another character into a space, or holds a character that is
    # in no longer piece. Paths of different units are independent.
    alone = ~vocabulary.inner[np.minimum(text, 0xFFFF)] | (text > 0xFFFF)
    begins = np.zeros(n, bool)
    begins[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    begins[1:] |= (text[1:] == SPACE) & (text[:-1] != SPACE) | alone[1:] | alone[:-1]
    start = np.flatnonzero(begins)
    stop = np.append(start[1:], n)
    rolled = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(text.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=rolled[1:])
    name = mixed((rolled[stop] - rolled[start]) * _powers(_INVERSE, n)[start] + (stop - start).astype(np.uint64))
    _, first, which = np.unique(name, return_index=True, return_inverse=True)
    length = stop[first] - start[first]
    source = np.repeat(start[first] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    lattice = lattices(vocabulary, text[source], length)
    root = (np.cumsum(length) - length + np.arange(len(length)))[which] if n else np.empty(0, np.int64)
    doc_of_unit = np.repeat(np.arange(docs), sizes)[start] if n else start
    unit_bounds = np.searchsorted(doc_of_unit, np.arange(docs + 1))
    local = np.arange(len(start)) - unit_bounds[doc_of_unit] if n else start

    searches = [Search(lattice, key, k) for key in keys[:, None]]
    nodes, lengths, count = walk(lattice, root, keys[doc_of_unit], local, 0)
    unit, log_p = np.repeat(np.arange(len(start)), count), lattice.log_p[nodes, lengths]
    bounds = np.searchsorted(unit, unit_bounds)
    for d, search in enumerate(searches):
        own = slice(bounds[d], bounds[d + 1])
        top = -np.log(-np.log(uniform(keys[d : d + 1], np.zeros(1), 5)[0]))
        search.add(nodes[own], lengths[own], unit[own], log_p[own], float(top), 0, ())
    for found in range(1, k):
        chosen = [(d, s, p) for d, s in enumerate(searches) if len(s.paths) == found and (p := s.part())]
        begin, who, tells, units = [], [], [], []
        for d, s, (_, number, j, step, _) in chosen:
            at, u = s.paths[number][0][j] + step + 1, s.paths[number][2][j]
            later = np.arange(u + 1, unit_bounds[d + 1])
            inside = [] if lattice.last[at] else [at]
            begin.append(np.concatenate([np.array(inside, np.int64), root[later]]))
            units.append(np.concatenate([np.full(len(inside), u), later]))
            who.append(len(begin[-1]))
            tells.append(keys[d])
        if not chosen:
            break
        all_units = np.concatenate(units)
        key = np.repeat(np.array(tells, np.uint64), who)
        nodes, lengths, count = walk(lattice, np.concatenate(begin), key, local[all_units], 16 * found + 3)
        unit, log_p = np.repeat(all_units, count), lattice.log_p[nodes, lengths]
        edge = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], np.cumsum(who)])]
        for i, (_, s, (value, number, j, step, out)) in enumerate(chosen):
            old, new = s.paths[number], slice(edge[i], edge[i + 1])
            s.add(
                np.concatenate([old[0][: j + 1], nodes[new]]),
                np.concatenate([old[1][:j], [step], lengths[new]]),
                np.concatenate([old[2][: j + 1], unit[new]]),
                np.concatenate([old[3][:j], lattice.log_p[old[0][j], [step]], log_p[new]]),
                value,
                j,
                out,
            )
    return [_described(vocabulary, lattice, s, k) for s in searches]


def _described(vocabulary: Vocabulary, lattice: Lattices, search: Search, k: int) -> list[dict]:
    bounds = sorted((-q[0] for q in search.queue), reverse=True)
    threshold = bounds[0] if bounds and len(search.paths) == k else -np.inf
    out = []
    for rank, ((nodes, lengths, _, log_p), value) in enumerate(zip(search.paths, search.values), 1):
        ids = lattice.piece[nodes, lengths].astype(np.int64)
        if (ids < 0).any():
            ids = spell(vocabulary, ids, lattice.character[nodes])
        total = float(log_p.sum(dtype=np.float64))
        row = {"rank": rank, "ids": ids, "log_prob": total, "perturbed": value}
        out.append(row | {"log_inclusion": log_inclusion(total, threshold)})
    return out


def spell(vocabulary: Vocabulary, ids: np.ndarray, character: np.ndarray) -> np.ndarray:
    """Ids with the bytes of each character that has no piece."""
    parts, at = [], 0
    for i in np.flatnonzero(ids < 0).tolist():
        c = int(character[i])
        raw = chr(SPACE if c == NO_CHARACTER else c).encode()
        parts += [ids[at:i], vocabulary.byte_ids[list(raw)]]
        at = i + 1
    return np.concatenate([*parts, ids[at:]])


OUTPUT = (
    "doc_id long, rank int, n_pieces long, ids_crc32 long, log_prob double, perturbed double, "
    "log_inclusion double, round_trip boolean"
)


def _encode(path: str, k: int, seed: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = known_vocabulary(path)
        for batch in split_documents(batches, 4 << 20):
            texts = [t.decode() for t in texts_of(batch)]
            names = ["" if d is None else str(d) for d in batch.column(0).to_pylist()]
            keys = mixed(np.array([_row_key(name, seed) for name in names], np.uint64))
            rows = []
            for doc, text, own in zip(batch.column(0).to_pylist(), texts, sample(vocabulary, texts, keys, k)):
                for s in own:
                    crc = zlib.crc32(s["ids"].astype("<u4").tobytes())
                    same = vocabulary.decode(s["ids"].tolist()) == text
                    row = (doc, s["rank"], len(s["ids"]), crc, s["log_prob"], s["perturbed"], s["log_inclusion"], same)
                    rows.append(row + ((s["ids"].tolist(),) if keep_ids else ()))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.float64()] * 3, pa.bool_()]
            kinds += [pa.list_(pa.int32())] if keep_ids else []
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            names = [f.split()[0] for f in OUTPUT.split(", ")] + ["ids"] * keep_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return run


def _row_key(name: str, seed: int) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(name.encode(), seed)


def encode(docs: DataFrame, path: str, k: int = SAMPLES, seed: int = 0, keep_ids: bool = False) -> DataFrame:
    """k distinct sampled segmentations of every whole text, without replacement.

    Columns: rank by perturbed log-probability, number and checksum (ids as little-endian
    unsigned 32-bit numbers) of the ids, log-probability, perturbed value, the log of the chance of
    inclusion given the next perturbed value, and whether decoding gives the text back. Reads
    `doc_id` and `text`. All randomness comes from doc_id and seed, so rows that repeat and runs
    that repeat give the same samples. A null or empty text has one segmentation, without
    pieces; a text with fewer than k segmentations gives them all. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_encode(path, k, seed, keep_ids), OUTPUT + (", ids array<int>" if keep_ids else ""))


def decode(rows: DataFrame, path: str) -> DataFrame:
    """`text` for each row's `ids`, which must come as array<int>; other columns stay. Null stays null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = known_vocabulary(path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids")).to_pylist()
            texts = [None if own is None else vocabulary.decode(own) for own in ids]
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in kept] + [pa.array(texts, pa.string())],
                names=[*kept, "text"],
            )

    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(run, f"{schema}, text string")


def op2_sentencepiece_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), vocabulary_path(VOCABULARY))
