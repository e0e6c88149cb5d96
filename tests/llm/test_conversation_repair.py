"""Operator 11 against plain Python: damage, faults, cheapest edits by enumeration and by a plain table."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from truerow.llm import conversation_repair as cr
from truerow.llm.common import table

SF = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"
VALID = re.compile(r"(s?(ua)+)?")


def plain_damage(rows):
    """conv_id -> its rows (role, text, turn) after damage, in order."""
    found = {}
    for conv, turn, role, text in rows:
        own = found.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for own in found.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return found


def faults_of(own):
    seen, found = set(), []
    for _, role, text in own:
        visible = text.strip(SPACES)
        fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
        seen.add((role, text))
        found.append(fault)
    return found


def plain_repair(own):
    """Cheapest (cost, edits, repaired rows) row by row, inserts tried one by one."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def with_inserts(best):
        for _ in range(3):
            for state, (cost, edits, rows) in list(best.items()):
                for role in after[state]:
                    if role in names:
                        new = (cost + 5, edits + "I", rows + [(names[role], "")])
                        if role not in best or new[:2] < best[role][:2]:
                            best[role] = new
        return best

    best = with_inserts({"": (0, "", [])})
    for (_, role, text), fault in zip(own, faults_of(own)):
        new = {}

        def offer(state, entry):
            if state not in new or entry[:2] < new[state][:2]:
                new[state] = entry

        for state, (cost, edits, rows) in best.items():
            offer(state, (cost + 2, edits + "D", rows))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault else 0
            if role[:1] and role[:1] in after[state]:
                offer(role[0], (cost + extra, edits + "K", rows + [(role, text)]))
            for target in after[state]:
                if target in names:
                    offer(target, (cost + extra + 1, edits + "R", rows + [(names[target], text)]))
        best = with_inserts(new)
    return min((best[s] for s in ("", "a") if s in best), key=lambda e: e[:2])


def plain_row(own):
    faults = faults_of(own)
    turns = {t for t, _, _ in own if t is not None}
    initials = [r[:1] for _, r, _ in own]
    cost, edits, rows = plain_repair(own)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rows).encode()).hexdigest()
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, edits, digest


def expected(rows):
    return {conv: plain_row(own) for conv, own in plain_damage(rows).items()}


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def run(spark, rows, tmp_path):
    schema = "conv_id long, turn long, role string, text string, copies string, place long, c long, audit string"
    folder = str(tmp_path)
    frame = spark.createDataFrame([(*r, "x", 9, 8, "z") for r in rows], schema)
    frame.write.parquet(f"{folder}/conversations.parquet")
    found = cr.op11_conversation_repair(spark, folder).collect()
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in found}
    assert len(got) == len(found)
    return got


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = cr.op11_conversation_repair(spark, SF).collect()
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in found} == expected(rows)


def test_odd_rows(spark, tmp_path):
    """Nulls everywhere, equal turns, repeated rows, odd roles, empty and long texts, a hot conversation."""
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User", "assistant-2", "ß"]
    texts = ["Yes.", "No", "", None, " \t\n", "Why?", "Ünï ", "a!\x0b ", "word " * 5000 + ".", "?", " "]
    rows = []
    for conv in [None, *range(60)]:
        turn = 0
        for _ in range(rng.randrange(9)):
            turn += rng.choice([0, 1, 1, 1, 3])
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(roles), rng.choice(texts)))
    rows += rows[:40]
    rows += [(77, t, "ua"[t % 2] if t % 7 else "s", f"t{t % 50}.") for t in range(3000)] + [(78, 1, "user", "a.")] * 900
    rng.shuffle(rows)
    assert run(spark, rows, tmp_path) == expected(rows)


def test_no_rows(spark, tmp_path):
    assert run(spark, [], tmp_path) == {}


def test_small_blocks_and_any_rules_change_nothing(spark, monkeypatch):
    """The result depends neither on the rules nor on where blocks end."""
    rng = random.Random(9)
    sequences = ["".join(rng.choices(cr.TERMINALS, k=rng.randrange(1, 60))) for _ in range(60)]
    frame = spark.createDataFrame([(s,) for s in sequences * 2], "symbols string")
    rules = cr.learn_rules(frame, rounds=4, most=6)
    assert len(rules) > 6 and all(len(pair) == 2 for pair, _ in rules)
    plain, shared = cr.matrices([]), cr.matrices(rules)
    for s in sequences:
        vectors = []
        for text, known in ((s, plain), (cr.compressed(s, rules), shared)):
            vector = [(0, ""), None, None, None]
            for symbol in text:
                vector = cr.times(vector, known[symbol])
            vectors.append(cr.finished(vector))
        assert vectors[0] == vectors[1]


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_cheapest_of_all_edits(n):
    """Every way to edit n rows with at most two inserts in a place."""
    known = cr.matrices([])
    for symbols in itertools.product(cr.TERMINALS, repeat=n) if n < 3 else random.Random(2).sample(list(itertools.product(cr.TERMINALS, repeat=3)), 60):
        best = None
        for edits in itertools.product("KuaD", repeat=n):
            if any(s == "x" and e != "D" or e == "K" and s.lower() == "o" for s, e in zip(symbols, edits)):
                continue
            for inserts in itertools.product(("", "u", "a", "ua", "au"), repeat=n + 1):
                roles, audit, cost = inserts[0], "I" * len(inserts[0]), 5 * sum(map(len, inserts))
                for s, e, more in zip(symbols, edits, inserts[1:]):
                    roles += ("" if e == "D" else s.lower() if e == "K" else e) + more
                    audit += ("R" if e in "ua" else e) + "I" * len(more)
                    cost += {"K": 0, "D": 2}.get(e, 1) + (5 if s.isupper() and e != "D" else 0)
                if VALID.fullmatch(roles) and (best is None or (cost, audit) < best):
                    best = cost, audit
        vector = [(0, ""), None, None, None]
        for s in symbols:
            vector = cr.times(vector, known[s])
        assert cr.finished(vector) == best


def test_repaired_rows_hash_to_the_digest(spark):
    rows = cr.damage(table(spark, SF, "conversations"))
    audits = cr.repair(rows)
    turns = {}
    for r in cr.repaired_turns(rows, audits).orderBy("conv_id", "place").collect():
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert len(turns[r.conv_id]) == r.place + 1 and r.edit in "KRI"
    for r in cr.repaired_digests(rows, audits).collect():
        assert r.repaired_sha256 == hashlib.sha256("\n".join(turns.get(r.conv_id, [])).encode()).hexdigest()
