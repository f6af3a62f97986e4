"""Conversation repair against a search through all edits, and its edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from millwright.llm import turns
from millwright.llm.queries import damaged, registry
from tests.conftest import SMALL


def cheapest(initials: str, faults) -> tuple[int, str]:
    """Of all edit sequences with at most three inserts in a gap; forwards, over (cost, audit, roles) as they stand."""
    found = {(0, "", "")}

    def inserted(states):
        every = set(states)
        for n in (1, 2, 3):
            for roles in product("ua", repeat=n):
                every |= {(c + 3 * n, a + "I" * n, r + "".join(roles)) for c, a, r in states}
        return {x for x in every if re.fullmatch(r"s?(ua)*u?", x[2])}

    found = inserted(found)
    for role, fault in zip(initials, faults):
        after = set()
        for c, a, r in found:
            after.add((c + 4, a + "D", r))
            if fault in (turns.SOUND, turns.TRUNCATED):
                more = 3 if fault == turns.TRUNCATED else 0
                after.add((c + more, a + "K", r + role))
                after |= {(c + more + 3, a + "R", r + x) for x in "ua"}
        # states that agree in the end of their roles have the same future; all of the cheapest are kept
        found = inserted({x for x in after if re.fullmatch(r"s?(ua)*u?", x[2])})
        least = {}
        for c, _, r in found:
            key = (r == "", r[-1:])
            least[key] = min(c, least.get(key, c))
        found = {x for x in found if x[0] == least[x[2] == "", x[2][-1:]]}
    c, a, _ = min((x for x in found if re.fullmatch(r"(s?(ua)+)?", x[2])), key=lambda x: x[:2])
    return c, a


def test_parse_finds_the_cheapest_and_least_audit():
    rng = random.Random(3)
    cases = [("".join(p), bytes(f)) for n in range(4) for p in product("suao", repeat=n) for f in product((0, 1, 3), repeat=n)]
    cases += [
        ("".join(rng.choice("suao") for _ in range(6)), bytes(rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(6)))
        for _ in range(150)
    ]
    for initials, faults in cases:
        assert turns._parse(initials, faults) == cheapest(initials, faults), (initials, faults)


def test_parse_of_a_long_conversation():
    n = 20_000
    cost, audit = turns.parse("ua" * n, bytes(2 * n))
    assert (cost, audit) == (0, "K" * 2 * n)
    assert turns.parse("u" * n, bytes(n))[0] == 3 * (n // 2)


def plain(rows):
    """What the query returns, row by row in Python."""
    white = " \t\n\x0b\x0c\r"
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, [])
        or_space = lambda x: " " if x is None else str(x)
        fate = zlib.crc32(f"{or_space(conv)}:{or_space(turn)}".encode()) % 20
        role, text = or_space(role), or_space(text)
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        by[conv] += [(turn, role, text)] * (2 if fate == 3 else 1)
    for conv, mine in by.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in mine:
            end = text.rstrip(white)[-1:]
            faults.append(
                turns.BLANK if not end else turns.DUPLICATE if (role, text) in seen
                else turns.TRUNCATED if end not in ".!?" else turns.SOUND
            )
            seen.add((role, text))
        initials = "".join(r[:1] or "\0" for _, r, _ in mine)
        cost, audit = turns._parse(initials, bytes(faults))
        known = [t for t, _, _ in mine if t is not None]
        out, k = [], 0
        for letter in audit:
            want = "assistant" if out and out[-1][0][:1] == "u" else "user"
            if letter == "I":
                out.append((want, ""))
                continue
            if letter != "D":
                out.append((mine[k][1] if letter == "K" else want, mine[k][2]))
            k += 1
        assert re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] for r, _ in out))
        yield (
            conv, max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *[faults.count(f) for f in (turns.BLANK, turns.DUPLICATE, turns.TRUNCATED)],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
        )


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(spark, rows, path):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int, fault string, kind int")
    frame.repartition(5).write.parquet(f"{path}/conversations.parquet")
    found = registry()["op13_conversations"](spark, str(path))
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted((tuple(r[c] for c in COLUMNS) for r in found.collect()), key=key)
    assert got == sorted(plain([r[:4] for r in rows]), key=key)


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    found = registry()["op13_conversations"](spark, SMALL)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in found.collect()) == sorted(plain(rows))


def test_faulty_conversations(spark, tmp_path):
    rng = random.Random(6)
    rows = []
    for conv in [None, *range(80)]:
        for _ in range(rng.randrange(1, 9)):
            rows.append((
                conv, rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", "tool", "", None, "User"]),
                rng.choice([None, "", " \t", "Yes.", "Yes. \n", "no", " ", "é!", "a\nb?", "a.b"]), 1, "x", 2,
            ))
    rows += rows[:40]  # repeated rows
    rows += [(500, k, "user" if k % 2 else "assistant", "long " * 20_000 + "." * (k % 3), 1, "x", 2) for k in range(30)]
    check(spark, rows, tmp_path)


def test_one_conversation_with_most_rows(spark, tmp_path):
    """More rows than a batch of either kind holds."""
    rows = [(1, k, ("user", "assistant", "assistant")[k % 3], f"row {k}.", 1, "x", 2) for k in range(25_000)]
    check(spark, rows + [(2, 1, "user", "Hi.", 1, "x", 2)], tmp_path)


def test_empty_table(spark, tmp_path):
    check(spark, [], tmp_path)


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Well."), (1, 2, "user", ""), (2, 0, "user", None)]
    found, fixed = turns.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [tuple(r) for r in fixed.orderBy("conv_id", "place").collect()] == [
        (1, 0, "system", "Be brief.", "K"), (1, 1, "user", "", "I"), (1, 2, "assistant", "Well.", "K"),
    ]
    assert {r.conv_id: (r.cost, r.audit) for r in found.collect()} == {1: (7, "KIKD"), 2: (4, "D")}


def test_damage_keeps_other_rows(spark):
    rows = spark.createDataFrame([(k, 0, "user", "A. b!") for k in range(200)], "conv_id long, turn long, role string, text string")
    assert {r.text for r in damaged(rows).collect()} == {"A. b!", "", "A b"}


@pytest.mark.parametrize("initials", ["", "ua", "sua", "suaua"])
def test_sound_conversations_stay(initials):
    assert turns.parse(initials, bytes(len(initials))) == (0, "K" * len(initials))
