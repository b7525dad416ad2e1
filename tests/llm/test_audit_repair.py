"""Audits against all edit sequences, the persistent order against plain
strings, and damaged conversations with nulls, ties, copies and long texts."""

import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streetpulse.llm import audit_repair as A

GOOD = re.compile(r"(s?(ua)+)?\Z")


def brute(codes, inserts=4):
    """Least (cost, audit) over all edit sequences with few inserts."""
    rows = [codes[i:i + 2] for i in range(0, len(codes), 2)]
    best = None
    choices = []
    for initial, fault in rows:
        more = 3 if fault == "1" else 0
        own = [("D", 4, "")]
        if fault != "2":
            own += [("K", more, initial), ("R", 3 + more, "u"), ("R", 3 + more, "a")]
        choices.append(own)
    gaps = len(rows) + 1
    for places in itertools.chain.from_iterable(itertools.combinations_with_replacement(range(gaps), k) for k in range(inserts + 1)):
        for roles in itertools.product("ua", repeat=len(places)):
            for edits in itertools.product(*choices):
                audit, initials, cost = "", "", 3 * len(places)
                for gap in range(gaps):
                    for place, role in zip(places, roles):
                        if place == gap:
                            audit, initials = audit + "I", initials + role
                    if gap < len(rows):
                        audit, initials, cost = audit + edits[gap][0], initials + edits[gap][2], cost + edits[gap][1]
                if GOOD.match(initials) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


CODES = st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from("012")).map("".join), max_size=3).map("".join)


@settings(max_examples=60, deadline=None)
@given(CODES)
def test_least_audit_is_that_of_all_edit_sequences(codes):
    table = [(A.START, s, c, p) for s, c, p in A.least_audits(codes, A.START)]
    cost, pieces = A.joined([table])
    assert (cost, "".join(pieces)) == brute(codes)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from("012")).map("".join), max_size=14), st.integers(1, 4))
def test_segments_compose_to_the_whole(rows, size):
    whole = A.joined([[(A.START, *x) for x in A.least_audits("".join(rows), A.START)]])
    parts = ["".join(rows[i:i + size]) for i in range(0, len(rows), size)]
    cost, pieces = A.joined([[(q, *x) for q in range(4) for x in A.least_audits(p, q)] for p in parts])
    assert (cost, "".join(pieces)) == (whole[0], "".join(whole[1]))


@pytest.mark.parametrize("modulus", [A.MODULUS, 5, 1])
def test_order_of_nodes_is_that_of_strings_also_when_hashes_collide(monkeypatch, modulus):
    monkeypatch.setattr(A, "MODULUS", modulus)
    root, nodes = A.Edits(), []
    for n in range(5):
        nodes += [(s, s) for s in map("".join, itertools.product("DIK", repeat=n))]

    def built(s):
        node = root
        for letter in s:
            node = A.Edits(letter, node)
        return node
    for s, _ in nodes[::7]:
        for t, _ in nodes[::5]:
            assert A.comes_first(built(s), built(t)) == (s < t)
            assert built(s).spelled() == s
    long = built("K" * 3000)
    assert long.at(1234).depth == 1234 and A.comes_first(A.Edits("D", long), A.Edits("K", long))


def expected(rows):
    """Plain version over rows (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        held = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            harm = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if harm == 0:
                continue
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            held += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in held:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                          "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        codes = "".join((r[1][:1] if r[1][:1] in tuple("sua") else "x") + {"": "0", "truncated": "1"}.get(f, "2")
                        for r, f in zip(held, faults))
        cost, audit = min(((c, p) for s, c, p in A.least_audits(codes, A.START) if s in A.ENDS), default=(0, ""))
        lines, state, at = [], A.START, 0
        for letter in audit:
            if letter == "D":
                at += 1
                continue
            if letter == "K":
                state = A._kept_next(state, held[at][1][0])
                lines.append(f"{held[at][1]}:{held[at][2]}")
            else:
                state = A._said_next(state)
                lines.append(f"{A.SAID[state]}:{held[at][2] if letter == 'R' else ''}")
            at += letter != "I"
        turns = [r[0] for r in held if r[0] is not None]
        initials = [r[1][:1] for r in held]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
                     faults.count("duplicate"), faults.count("truncated"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if extra:
        for c in ("ord", "seg", "fault", "audit", "piece", "harm", "digest"):
            df = df.withColumn(c, F.lit("x"))
    return [tuple(r) for r in A.damaged_and_repaired(spark, df).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()]


ROWS = ([(c, t, role, f"{role} says {c} {t}{'.' if (c + t) % 3 else ''}") for c in range(30)
         for t, role in enumerate(["system", "user", "assistant", "user", "assistant"][c % 2:])]
        + [(50, None, "user", "b."), (50, None, None, "a."), (50, 3, "tool", None), (50, 9, "", "c!"), (50, 9, "user", "")]
        + [(None, None, None, None), (None, 1, "user", "hello?"), (None, 2, "assistant", "x" * 300_000 + ".")]
        + [(60, 1, "user", "again.")] * 5 + [(61, 4, "u", " \t\n\x0b"), (62, 2, "umbrella", "é😀."), ((1 << 60) + 1, 1, "user", "far.")])


@pytest.mark.parametrize("bits, extra", [(12, False), (1, True)])
def test_damaged_conversations_equal_the_plain_version(spark, monkeypatch, bits, extra):
    monkeypatch.setattr(A, "SEGMENT_BITS", bits)
    found = got(spark, ROWS, extra)
    assert len(found) == len({r[0] for r in ROWS})
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = expected(ROWS)
    assert {r[0]: r[1:] for r in found} == {c: want.get(c, none) for c in {r[0] for r in ROWS}}


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(A, "SEGMENT_BITS", 5)
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t % 700}{'.' if t % 11 else ''}") for t in range(1500)]
    assert {r[0]: r[1:] for r in got(spark, rows)} == expected(rows)


def test_empty_table(spark):
    assert got(spark, []) == []
