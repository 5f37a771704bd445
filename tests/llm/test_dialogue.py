"""Repaired conversations against a plain version that keeps whole strings in its DP."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest

from tickweave.llm import dialogue
from tickweave.llm.catalog import queries
from tickweave.llm.common import table

ROWS = "conv_id long, turn long, role string, text string"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEED = {0: 2, 1: 2, 2: 3, 3: 2}
NAME = {2: "user", 3: "assistant"}


def fault_of(role, text, seen):
    bare = text.strip(" \t\n\v\f\r")
    if not bare:
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    seen.add((role, text))
    return "" if bare[-1] in ".!?" else "truncated"


def cheapest(initials, faults):
    """(cost, audit), least of both, by a DP over whole audits."""

    def with_inserts(best):
        for _ in range(2):
            best = [min(best[s], (5 + best[NEED[s]][0], "I" + best[NEED[s]][1])) for s in range(4)]
        return best

    far = (10**9, "")
    after = with_inserts([(0, ""), far, far, (0, "")])
    for initial, fault in zip(reversed(initials), reversed(faults)):
        best = []
        for s in range(4):
            ways = [(2 + after[s][0], "D" + after[s][1])]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if (s, initial) in STEP:
                    cost, audit = after[STEP[s, initial]]
                    ways.append((more + cost, "K" + audit))
                cost, audit = after[NEED[s]]
                ways.append((more + 1 + cost, "R" + audit))
            best.append(min(ways))
        after = with_inserts(best)
    return after[0]


def plain(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        kept = convs[conv]
        mark = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(mark.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    found = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()[:16]))
        turns = {t for t, *_ in kept if t is not None}
        seen = set()
        faults = [fault_of(role, text, seen) for _, role, text in kept]
        initials = [role[:1] for _, role, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(initials, faults)
        lines, state, rest = [], 0, iter(kept)
        for letter in audit:
            _, role, text = ("", "", "") if letter == "I" else next(rest)
            if letter == "K":
                state = STEP[state, role[:1]]
            elif letter != "D":
                state = NEED[state]
                role = NAME[state]
            if letter != "D":
                lines.append(f"{role}:{text}")
        found[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal,
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return found


def result(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[1:]) for r in rows}


def some_rows(seed):
    pick = random.Random(seed).choice
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "Über"]
    texts = ["a.", "b!", "hello", "", "  ", "\t\v\n", None, "x? \n", "y.y", "é。", "a.", " "]
    rows = []
    for conv in [*range(150), None]:
        for k in range(pick([1, 2, 3, 4, 6, 9, 21])):
            rows.append((conv, pick([k, k, k, k // 2, None]), pick(roles), pick(texts)))
    for conv, n in ((1000, 50), (1001, 17), (1002, 133)):
        rows += [(conv, k, pick(roles[:5]), f"text {pick(range(n))}{pick('.!? ab')}") for k in range(n)]
    return rows


def test_query_against_plain_version(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = queries()["op12_conversation_repair"](spark, sf_dir)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {t for c, t in found.dtypes if c not in ("audit", "repaired_sha256")} == {"bigint"}
    assert result(found) == plain(map(tuple, given.collect()))


@pytest.mark.parametrize("block", [1024, 3])
def test_odd_rows_in_blocks_of_any_size(spark, monkeypatch, block):
    monkeypatch.setattr(dialogue, "BLOCK", block)
    rows = some_rows(block)
    df = spark.createDataFrame(rows, ROWS).repartition(6)
    assert result(dialogue.repaired_conversations(df)) == plain(rows)


def test_audits_against_all_scripts():
    """Short conversations against every sequence of edits there is."""
    sound = re.compile("(s?(ua)+)?")

    def scripts(signs):
        """Every audit up to its length with the roles it can give and its cost."""
        for n in range(len(signs) + 7):
            for audit in product("DIKR", repeat=n):
                rows = [c for c in audit if c != "I"]
                if len(rows) != len(signs) or audit.count("I") > 4:
                    continue
                left, options, cost = list(signs), [""], 0
                for letter in audit:
                    sign = None if letter == "I" else left.pop(0)
                    if letter == "D":
                        cost += 2
                        continue
                    if sign == "x" or (letter == "K" and sign in "oO"):
                        break
                    cost += {"I": 5, "K": 0, "R": 1}[letter] + 5 * bool(sign and sign.isupper())
                    gives = sign.lower() if letter == "K" else "ua"
                    options = [o + g for o in options for g in gives]
                else:
                    if any(sound.fullmatch(o) for o in options):
                        yield cost, "".join(audit)

    for signs in ("", "u", "a", "s", "ua", "us", "au", "uu", "Ua", "xu", "sA", "oO", "sua", "aau", "UAU", "xxa"):
        codes = dialogue._CODE[list((signs + "$").encode())][None]
        cost, _, audit = dialogue.least_paths(codes, dialogue.np.zeros((1, 4), int), dialogue.np.zeros(1, int))
        assert (cost[0, 0], audit[0]) == min(scripts(signs)), signs


def test_a_long_conversation(spark):
    """One conversation with most of the rows, in many blocks."""
    pick = random.Random(9).choice
    rows = [(1, k, pick(["user", "assistant", "system"]), f"{pick(range(4000))}{pick('..?x')}") for k in range(9000)]
    rows += [(c, k, "user", "hm.") for c in range(2, 20) for k in range(3)]
    assert result(dialogue.repaired_conversations(spark.createDataFrame(rows, ROWS))) == plain(rows)


def test_all_rows_dropped(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    found = dialogue.repaired_conversations(spark.createDataFrame([(5, turn, "user", "a.")], ROWS)).collect()
    assert tuple(found[0]) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table(spark):
    assert dialogue.repaired_conversations(spark.createDataFrame([], ROWS)).count() == 0


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "hi.", "k"), (1, 1, "user", "and?", "k"), (1, 2, "assistant", "yes.", "k"), (2, 5, "system", "x", "k")]
    df = spark.createDataFrame(rows, ROWS + ", kind string").selectExpr("*", "1 as block", "'e' as edit")
    _, audits, repaired = dialogue.repair(df)
    assert {r.conv: r.audit for r in audits.collect()} == {"v1": "DKK", "v2": "D"}
    assert [tuple(r) for r in repaired.filter("conv = 'v1'").collect()] == [
        ("v1", "D", 0, "user", "hi."),
        ("v1", "K", 1, "user", "and?"),
        ("v1", "K", 2, "assistant", "yes."),
    ]


def test_a_very_long_text(spark):
    rows = [(1, 0, "user", "word " * 400_000), (1, 1, "assistant", ". " * 300_000)]
    assert result(dialogue.repaired_conversations(spark.createDataFrame(rows, ROWS))) == plain(rows)
