import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from corpusloom.llm import conversations
from corpusloom.llm.conversations import ANY, END, Repair, damaged, run_back, trace

SHAPE = re.compile(r"(s?(ua)+)?")
VISIBLE = re.compile(r"[^\x20\x09-\x0d]")


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        shown = VISIBLE.findall(text)
        if not shown:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("none" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by looking at edit sequences in the order of their cost."""
    faults = faults_of(rows)
    tie = itertools.count()
    heap = [(0, "", next(tie), 0, ())]
    while heap:
        cost, audit, _, at, made = heapq.heappop(heap)
        initials = "".join(r[:1] or "?" for r, _ in made)
        if at == len(rows) and SHAPE.fullmatch(initials):
            return cost, audit, made
        options = [("I", 5, at, ("user", "")), ("I", 5, at, ("assistant", ""))]
        if at < len(rows):
            _, role, text = rows[at]
            options.append(("D", 2, at + 1, None))
            if faults[at] not in ("blank", "duplicate"):
                more = 5 if faults[at] == "truncated" else 0
                options.append(("K", more, at + 1, (role, text)))
                options += [("R", 1 + more, at + 1, (r, text)) for r in ("user", "assistant")]
        for letter, extra, then, row in options:
            after = made + ((row,) if row else ())
            shape = "".join(r[:1] or "?" for r, _ in after)
            if any(SHAPE.fullmatch(shape + rest) for rest in ("", "a", "ua")):
                heapq.heappush(heap, (cost + extra, audit + letter, next(tie), then, after))


def expected(rows):
    """The report of one conversation's rows, in order."""
    turns = {t for t, _, _ in rows if t is not None}
    faults, initials = faults_of(rows), [r[:1] for _, r, _ in rows]
    cost, audit, made = cheapest(rows)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
    )


def ordered(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        groups[conv].append((turn, role, text))
    def key(r):
        return r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()
    return {conv: sorted(own, key=key) for conv, own in groups.items()}


def table(spark, rows):
    made = spark.createDataFrame(
        [(*r, *"abcdefgh") for r in rows],
        "conv_id bigint, turn bigint, role string, text string, conv string, idx string, mark string, "
        "chunk string, codes string, blank string, cut string, part string",
    )
    return made.repartition(3)


def check(spark, rows):
    repair = Repair(table(spark, rows))
    got = {r.conv_id: tuple(r)[1:] for r in repair.report().collect()}
    assert got == {conv: expected(own) for conv, own in ordered(rows).items()}
    return repair


def test_equals_a_search_over_all_edits(spark):
    rng = random.Random(4)
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "user", "assistant", "assistant", "system", "tool", ""])
            text = rng.choice(["Fine.", "Yes!", "open end", "", " \n", f"{turn}?", "ok. \t", "é 漢"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    check(spark, rows)


def test_odd_rows(spark):
    long = "word. " * 200_000
    rows = [
        (None, None, None, None), (None, 1, "user", "a."), (1, None, "user", "b."), (1, None, "user", "b."),
        (1, -5, "assistant", "c."), (1, 2**40, "user", "d."), (2, 0, "user", long), (2, 1, "assistant", long + "x."),
        (3, 0, "s", "."), (3, 0, "s", "."), (4, 1, "USER", "A."), (5, 1, "", ""),
    ]
    repair = check(spark, rows)
    kept = [r for r in repair.rows().collect() if r.conv_id == 2]
    assert [(r.position, r.role, r.edit, r.turn) for r in kept][:1] == [(0, "user", "K", 0)]
    for own in repair.rows().collect():
        assert own.edit in "KRI"


def test_empty_table(spark):
    repair = Repair(spark.createDataFrame([], "conv_id string, turn int, role string, text string"))
    assert repair.report().collect() == [] and repair.rows().collect() == []


def whole(codes):
    return trace(codes, run_back(codes, END), conversations.START)


@pytest.mark.parametrize("size", [1, 3, 7])
def test_passes_end_with_the_vectors_of_one_run(size):
    rng = random.Random(size)
    for _ in range(60):
        codes = "".join(rng.choice("BCDACDOPEIJ") for _ in range(rng.randrange(1, 60)))
        one = run_back(codes, END)
        parts = [codes[i : i + size] for i in range(0, len(codes), size)]
        runs = [run_back(p, END if k == len(parts) - 1 else ANY) for k, p in enumerate(parts)]
        entries = [r[-1] for r in runs]
        passes = 0
        while True:
            wrong = [k for k in range(len(parts) - 1) if runs[k + 1][0] != entries[k]]
            if not wrong:
                break
            passes += 1
            starts = [r[0] for r in runs]
            for k in wrong:
                runs[k], entries[k] = run_back(parts[k], starts[k + 1], runs[k]), starts[k + 1]
        assert passes <= len(parts)
        assert [v for r in runs for v in r[:-1]] + [runs[-1][-1]] == one


def test_a_stopped_run_keeps_what_lies_before():
    codes = "CD" * 500
    far = run_back(codes, ANY)
    again = run_back(codes, END, far)
    assert again == run_back(codes, END)
    assert again[:400] == far[:400]


def test_long_conversations_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK", 4)
    monkeypatch.setattr(conversations, "FAN", 3)
    rng = random.Random(9)
    rows = []
    for conv, size in ((1, 400), (2, 3), (3, 57), (None, 90), (4, 1)):
        for turn in range(size):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool"])
            rows.append((conv, turn, role, rng.choice([f"t{turn}.", f"t{turn}", "same.", "", "same"])))
    repair = Repair(table(spark, rows))
    got = {r.conv_id: r for r in repair.report().collect()}
    for conv, own in ordered(rows).items():
        letters = {"none": 0, "blank": 1, "duplicate": 2, "truncated": 3}
        codes = "".join(
            chr(65 + 4 * letters[f] + max(" sua".find(r[:1]), 0))
            for (_, r, _), f in zip(own, faults_of(own), strict=True)
        )
        audit, state = whole(codes)
        audit += "I" * (END[state] // 5)
        row = got[conv]
        assert row.audit == audit
        shape = "".join(r.role[0] for r in sorted(repair_rows(repair, conv), key=lambda r: r.position))
        assert SHAPE.fullmatch(shape) and len(shape) == sum(audit.count(x) for x in "KRI")
        assert row.cost == run_cost(codes, audit)
    assert max(r.cost for r in got.values()) > 100


def repair_rows(repair, conv):
    return [r for r in repair.rows().collect() if r.conv_id == conv]


def run_cost(codes, audit):
    """Total by the absolute recursion, without taking a minimum off."""
    vector = END
    for code in reversed(codes):
        vector = conversations.costs_before(vector, code)
    assert len(audit.replace("I", "")) == len(codes)
    return vector[0]


def test_damage(spark):
    rows = [(c, t, r, "a. b! c?") for c in range(12) for t, r in enumerate(["system", "assistant"] * 4)]
    rows += [(None, None, None, None), (3, None, "user", None)]
    got = sorted((tuple(r) for r in damaged(table(spark, rows)).collect()), key=str)
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        part = zlib.crc32(name.encode()) % 20
        role, text = role or " ", " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(part, text)
        out += [(conv, turn, "user" if part == 4 else role, text)] * {0: 0, 3: 2}.get(part, 1)
    assert got == sorted(out, key=str)
