"""Repair of conversation structure by grammar-compressed dynamic programming (operator 11).

A conversation becomes a sequence of symbols, one per row, for role and fault. Re-Pair rules learnt
over all conversations shorten the sequences. Every symbol, and so every rule, has one min-plus
matrix between four states (nothing yet, after system, user or assistant) whose entries hold the
least cost and the rope of edits that reaches it; rules are evaluated bottom-up once and shared
by all conversations.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from hashlib import sha256
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from truerow.llm.common import stored, table

KEEP, REROLE, DELETE, INSERT = "KRDI"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
#: What a truncated row costs unless it is deleted.
TRUNCATED = 5
#: States: nothing yet, after system, after user, after assistant; the role that each step adds.
START, SYSTEM, USER, ASSISTANT = range(4)
STATE_OF = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
STEPS = {"s": (START,), "u": (START, SYSTEM, ASSISTANT), "a": (USER,)}
#: A repaired conversation is empty or ends with an assistant.
ENDS = (START, ASSISTANT)
#: Symbols: a role's initial (o: none of the three), upper-case where truncated, x: must go.
GONE = "x"
TERMINALS = "suaoSUAO" + GONE
#: Symbols in one block of a conversation; blocks are evaluated one after the other.
BLOCK = 4096
#: Re-Pair rounds and new rules a round. Fewer rules only leave longer sequences.
ROUNDS, RULES = 8, 32
#: Compressed blocks whose symbols a task remembers.
MOST_REMEMBERED = 20_000

_VISIBLE = r"[^\x20\x09-\x0D]"
_COMPLETE = r"[.!?][\x20\x09-\x0D]*\z"

# Ropes: a string, or a pair of ropes.


def joined(a, b):
    if not a or not b:
        return a or b
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 64:
        return a + b
    return (a, b)


def leaves(rope) -> Iterator[str]:
    todo = [rope]
    while todo:
        top = todo.pop()
        if isinstance(top, str):
            yield top
        else:
            todo += (top[1], top[0])


def text_of(rope) -> str:
    return "".join(leaves(rope))


def before(a, b) -> bool:
    """Whether rope a comes before rope b in ASCII order."""
    if a is b:
        return False
    one, other = leaves(a), leaves(b)
    x = y = ""
    while True:
        x, y = x or next(one, None), y or next(other, None)
        if x is None or y is None:
            return x is None and y is not None
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


# Matrices: 16 entries (cost, rope) or None, from state i to state j at 4 * i + j. A vector is one row.
# Two edits of equal cost between the same states never are each other's beginning, since the
# rest would be inserts, which cost: so the least of the beginnings is the beginning of the least.


def times(left: Sequence, right: Sequence) -> list:
    """The min-plus product of a matrix (or of a vector) and a matrix, ties to the ASCII-least rope."""
    found: list = [None] * len(left)
    for at, a in enumerate(left):
        if a is None:
            continue
        row, k = at - at % 4, at % 4
        for j in range(4):
            b = right[4 * k + j]
            if b is None:
                continue
            cost, old = a[0] + b[0], found[row + j]
            if old is None or cost < old[0]:
                found[row + j] = (cost, joined(a[1], b[1]))
            elif cost == old[0]:
                rope = joined(a[1], b[1])
                if before(rope, old[1]):
                    found[row + j] = (cost, rope)
    return found


def _edges(*edges: tuple[int, int, int, str]) -> list:
    matrix: list = [None] * 16
    for i, j, cost, edit in edges:
        if (old := matrix[4 * i + j]) is None or (cost, edit) < old:
            matrix[4 * i + j] = (cost, edit)
    return matrix


def _steps(role: str, cost: int, edit: str) -> list[tuple[int, int, int, str]]:
    return [(i, STATE_OF[role], cost, edit) for i in STEPS[role]]


_STAY = [(i, i, 0, "") for i in range(4)]
_ONE = _edges(*_STAY, *_steps("u", COSTS[INSERT], INSERT), *_steps("a", COSTS[INSERT], INSERT))
#: Any number of inserts; more than two between the same states never pay.
INSERTS = times(_ONE, _ONE)


def terminal_matrix(symbol: str) -> list:
    """Inserts, then what may become of the row."""
    edges = [(i, i, COSTS[DELETE], DELETE) for i in range(4)]
    if symbol != GONE:
        extra = TRUNCATED if symbol.isupper() else 0
        for role in "ua":
            edges += _steps(role, COSTS[REROLE] + extra, REROLE)
        if symbol.lower() in STATE_OF:
            edges += _steps(symbol.lower(), COSTS[KEEP] + extra, KEEP)
    return times(INSERTS, _edges(*edges))


def matrices(rules: Sequence[tuple[str, str]]) -> dict[str, list]:
    """One matrix per symbol; a rule's is the product of its two symbols', evaluated bottom-up."""
    found = {symbol: terminal_matrix(symbol) for symbol in TERMINALS}
    for pair, symbol in rules:
        found[symbol] = times(found[pair[0]], found[pair[1]])
    return found


def compressed(symbols: str, rules: Sequence[tuple[str, str]]) -> str:
    for pair, symbol in rules:
        symbols = symbols.replace(pair, symbol)
    return symbols


def finished(vector: Sequence) -> tuple[int, str]:
    """The cheapest way to a permitted end, ties to the ASCII-least edits."""
    best = None
    ended = times(vector, INSERTS)
    for state in ENDS:
        entry = ended[state]
        if entry and (best is None or entry[0] < best[0] or (entry[0] == best[0] and before(entry[1], best[1]))):
            best = entry
    return best[0], text_of(best[1])


# Learning the rules


def _pairs(rules: Sequence[tuple[str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for symbols, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                short = compressed(symbols, rules)
                for pair, times_ in Counter(map("".join, zip(short, short[1:]))).items():
                    found[pair] += n * (short.count(pair) if pair[0] == pair[1] else times_)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["pair", "n"]
        )

    return run


def learn_rules(blocks: DataFrame, rounds: int = ROUNDS, most: int = RULES) -> list[tuple[str, str]]:
    """Re-Pair over all blocks, equal ones counted once: (pair, new symbol) in order of use.

    A round replaces the most frequent pairs of which none can overlap another. Pairs are counted by
    the tasks and summed; the driver sees at most (symbols x symbols) sums.
    """
    distinct = stored(blocks.groupBy("symbols").agg(F.count("*").alias("n")), "sequences")
    rules: list[tuple[str, str]] = []
    for _ in range(rounds):
        counted = distinct.mapInArrow(_pairs(rules), "pair string, n long")
        frequent = counted.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "pair")
        first, last, found = set(), set(), []
        for pair, _ in frequent.collect():
            a, b = pair
            if len(found) < most and b not in first and a not in last and (a != b or (a not in first and b not in last)):
                first.add(a)
                last.add(b)
                found.append((pair, chr(0xE000 + len(rules) + len(found))))
        if not found:
            break
        rules += found
    return rules


# Rows, faults and blocks


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by a hash of their key; copies 0 is a dropped row.

    A null counts as one space in role, text and the hashed key.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce("role", space))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return conversations.select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), text.alias("text"), copies.cast("long").alias("copies")
    )


def _text_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("text_key", F.unhex(F.sha2("text", 256)))


def mark_faults(rows: DataFrame) -> DataFrame:
    """One light row per distinct (conv_id, turn, role, text): the symbol of its first copy, and the faults of all.

    Repeated rows are summed before they are shuffled. Whether a (role, text) came earlier is told by the
    least turn that has it, joined back, so no conversation is gathered; adaptive execution splits
    a key with many turns.
    """
    light = (
        _text_key(rows)
        .groupBy("conv_id", "turn", "role", "text_key")
        .agg(
            F.sum("copies").alias("copies"),
            F.first(~F.col("text").rlike(_VISIBLE)).alias("blank"),
            F.first(~F.col("text").rlike(_COMPLETE)).alias("truncated"),
        )
    )
    light = stored(light, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = (
        light.where("copies > 0")
        .groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text_key").alias("k"))
        .agg(F.min(place).alias("first"))
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text_key") == F.col("k"))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin(*STATE_OF), initial).otherwise("o")
    leads = ~F.col("blank") & F.col("first").eqNullSafe(place)
    return light.join(firsts, same, "left").select(
        "conv_id", "turn", "role", "text_key", "copies", "blank", kind.alias("kind"), leads.alias("leads"),
        (leads & F.col("truncated")).alias("cut"),
    )


def count_faults(marked: DataFrame) -> DataFrame:
    """Per conversation its gaps and the numbers of blank, duplicate and truncated rows."""
    here = F.col("copies") > 0
    turn = F.when(here, F.col("turn"))
    copies = F.col("copies")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    return marked.groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("long").alias("gaps"),
        total(F.when(F.col("blank"), copies)).alias("blank"),
        total(F.when(~F.col("blank") & here, copies - F.col("leads").cast("int"))).alias("duplicate"),
        total(F.when(here, F.col("cut").cast("int"))).alias("truncated"),
    )


LEGAL = {"su", "ua", "au"}
_BLOCKS = "conv_id long, place long, symbols string, illegal long, first string, last string"


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted light rows to blocks of symbols, numbered in the order of rows over all tasks."""
    place = TaskContext.get().partitionId() << 33
    names = [c.split()[0] for c in _BLOCKS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    now, symbols, illegal, first, last = None, [], 0, "", ""
    done: list[tuple] = []

    def close() -> None:
        nonlocal place, illegal
        if symbols:
            done.append((now, place, "".join(symbols), illegal, first, last))
            place += 1
            symbols.clear()
            illegal = 0

    for batch in batches:
        for conv, copies, kind, leads, cut in zip(*(c.to_pylist() for c in batch.columns)):
            if conv != now or not symbols:
                close()
                now = conv
            while copies:
                if not symbols:
                    first = last = ""
                room = min(copies, BLOCK - len(symbols))
                symbols.extend((kind.upper() if cut else kind) if leads and not i else GONE for i in range(room))
                illegal += (room - 1) * (kind + kind not in LEGAL) + (last != "" and last + kind not in LEGAL)
                first, last, leads, copies = first or kind, kind, False, copies - room
                if len(symbols) == BLOCK:
                    close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
            done = []
    close()
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done) if done else [()] * 6, kinds)], names=names)


def blocks_of(marked: DataFrame) -> DataFrame:
    """Blocks of at most BLOCK symbols; a long conversation is cut at the bounds of the sorted ranges."""
    order = ["conv_id", "turn", "role", "text_key"]
    rows = marked.where("copies > 0").repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(rows.select("conv_id", "copies", "kind", "leads", "cut").mapInArrow(_cut_blocks, _BLOCKS), "blocks")


def _evaluate(rules: Sequence[tuple[str, str]], matrix: dict[str, list]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, str] = {}
        now, vector, illegal, last = None, None, 0, ""
        done: list[tuple] = []
        for batch in batches:
            for conv, symbols, inside, first, final in zip(*(c.to_pylist() for c in batch.columns)):
                if vector is None or conv != now:
                    if vector is not None:
                        done.append((now, *finished(vector), illegal))
                    now, vector, illegal, last = conv, [(0, ""), None, None, None], 0, ""
                if len(memory) >= MOST_REMEMBERED:
                    memory.clear()
                if symbols not in memory:
                    memory[symbols] = compressed(symbols, rules)
                for symbol in memory[symbols]:
                    vector = times(vector, matrix[symbol])
                illegal += inside + (last != "" and last + first not in LEGAL)
                last = final
            if done:
                yield _audits(done)
                done = []
        if vector is not None:
            done.append((now, *finished(vector), illegal))
        yield _audits(done)

    return run


def _audits(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 4
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "cost", "audit", "illegal"]
    )


def audit(blocks: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(conv_id, cost, audit, illegal) of all conversations with a row.

    The blocks of a conversation are read in order, with one vector of four entries between them.
    """
    rows = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return rows.select("conv_id", "symbols", "illegal", "first", "last").mapInArrow(
        _evaluate(rules, matrices(rules)), "conv_id long, cost long, audit string, illegal long"
    )


# Applying the edits


class _Editor:
    """Walks along one conversation's edits and gives its repaired rows (role, text, edit)."""

    def __init__(self, edits: str):
        self.edits, self.at, self.state = edits, 0, START

    def _next_role(self) -> str:
        role = "assistant" if self.state == USER else "user"
        self.state = STATE_OF[role[0]]
        return role

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.edits) and self.edits[self.at] == INSERT:
            self.at += 1
            yield self._next_role(), "", INSERT

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit == KEEP:
            self.state = STATE_OF[role[0]]
            yield role, text, KEEP
        elif edit == REROLE:
            yield self._next_role(), text, REROLE


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, head, row) in order: a head when a conversation begins, then each of its repaired rows.

    Reads sorted rows: of every conversation first the one with its edits, then its texts.
    """
    editor, now = None, None
    for batch in batches:
        for conv, edits, role, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
            if edits is not None:
                if editor is not None:
                    yield from ((now, None, row) for row in editor.inserted())
                editor, now = _Editor(edits), conv
                yield conv, True, None
            else:
                for _ in range(copies):
                    yield from ((now, None, row) for row in editor.row(role, text))
    if editor is not None:
        yield from ((now, None, row) for row in editor.inserted())


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    kept: list[tuple] = []
    for row in chain(rows, [None]):
        if row is not None:
            kept.append(row)
        if len(kept) >= size or (row is None and kept):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema
            )
            kept = []


_REPAIRED = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]
)
_DIGESTS = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])


def _repaired_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        place = 0
        for conv, head, row in _edited(batches):
            place = 0 if head else place + 1
            if row:
                yield conv, place - 1, *row

    return _batched(rows(), _REPAIRED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        now, digest, any_row = None, None, False
        for conv, head, row in _edited(batches):
            if head:
                if digest is not None:
                    yield now, digest.hexdigest()
                now, digest, any_row = conv, sha256(), False
            else:
                digest.update(f"{chr(10) * any_row}{row[0]}:{row[1]}".encode())
                any_row = True
        if digest is not None:
            yield now, digest.hexdigest()

    return _batched(rows(), _DIGESTS)


def _along_edits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Every conversation's edits, then its rows in order: sorted in one stream, never held together."""
    empty = F.lit(None)
    heads = audits.select(
        "conv_id", F.lit(0).alias("body"), "audit", empty.cast("long").alias("turn"), empty.cast("string").alias("role"),
        empty.cast("binary").alias("text_key"), empty.cast("string").alias("text"), F.lit(0).cast("long").alias("copies"),
    )
    body = _text_key(rows.where("copies > 0")).select(
        "conv_id", F.lit(1).alias("body"), empty.cast("string").alias("audit"), "turn", "role", "text_key", "text", "copies"
    )
    ordered = heads.union(body).repartition("conv_id").sortWithinPartitions("conv_id", "body", "turn", "role", "text_key")
    return ordered.select("conv_id", "audit", "role", "text", "copies")


def repaired_turns(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, edit): the rows of the repaired conversations."""
    return _along_edits(rows, audits).mapInArrow(_repaired_rows, "conv_id long, place long, role string, text string, edit string")


def repaired_digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the `role:text` lines of the repaired conversations."""
    return _along_edits(rows, audits).mapInArrow(_digests, "conv_id long, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation its faults, the cost of the cheapest repair and its edits (audit).

    `rows` has conv_id, turn, role, text (no null role or text) and copies, as `damage` gives them;
    other columns are not read. Rows are ordered by turn, null turns first; rows of one turn by role, then by
    the SHA-256 of their text. A null conv_id is a conversation like any other. A conversation whose rows are all
    dropped (copies 0) costs nothing and has an empty audit. A role that starts with none of
    s, u, a (also an empty one) cannot stay. An empty table gives no rows.

    Sequences are built over sorted ranges, so a conversation with a third of all rows is spread;
    only its compressed symbols, and for the repaired text its sorted rows, pass one task, as a
    stream. Its audit is one value by definition.
    """
    marked = stored(mark_faults(rows), "marked")
    blocks = blocks_of(marked)
    audits = audit(blocks, learn_rules(blocks))
    audits = audits.select(F.col("conv_id").alias("c"), "cost", "audit", "illegal")
    found = count_faults(marked).join(audits, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    none = F.lit(0).cast("long")
    return stored(
        found.select(
            "conv_id", "gaps", "blank", "duplicate", "truncated",
            F.coalesce("illegal", none).alias("illegal"),
            F.coalesce("cost", none).alias("cost"),
            F.coalesce("audit", F.lit("")).alias("audit"),
        ),
        "audits",
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damage(table(spark, sf_dir, "conversations"))
    found = repair(rows)
    digests = repaired_digests(rows, found).withColumnRenamed("conv_id", "c")
    return found.join(digests, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
