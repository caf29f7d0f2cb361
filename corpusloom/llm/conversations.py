"""Cheapest repair of conversations: a Viterbi recursion run in parallel by rank convergence.

A repaired conversation is empty or an optional system row and then pairs of a user and an
assistant row. Rows are kept, given another role or deleted, and empty rows inserted. Four
states (at the start, after system, after user, after assistant) and a cost for each make
the vector of the recursion, which runs from the last row to the first.

A conversation is cut into chunks of bounded length. Every chunk but the last starts from a
speculative vector. In a fix-up pass a chunk whose next chunk now begins with another vector
is run again from there, until its vector differs from the one it had by a constant only:
what lies before stays as it is. Passes go on until no chunk disagrees with the next one.
All vectors are then right up to a constant in each chunk, and differences are all that is
needed to trace: stitched together, the backward costs tell at each row which edits are part
of a cheapest repair, and the first of them by letter is taken. A chunk is traced from all
four states; the chunks' maps of states are composed blockwise, so that each chunk learns
the state it is entered in.

Conversations that lie in one chunk, nearly all of them, need no pass and no map.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import drop_table, written
from corpusloom.llm.words import blocks
from corpusloom.operators.indexing import with_index

#: Rows of a chunk at most, and chunks whose maps are composed at a time.
CHUNK, FAN = 1024, 256
BLANKS = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)
#: State after the row that is due in each state, and the role of that row.
DUE = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: A row's code is a letter: four for each fault, one for each initial.
FAULTS = ("none", "blank", "duplicate", "truncated")
INITIALS = " sua"

Vector = tuple[int, int, int, int]
#: Cost of ending in each state: a lone system row takes both rows of a pair.
END: Vector = (0, 2 * INSERT, INSERT, 0)
ANY: Vector = (0, 0, 0, 0)


def _parts(code: str) -> tuple[str, str]:
    number = ord(code) - 65
    return FAULTS[number // 4], INITIALS[number % 4]


@cache
def _kept_state(initial: str, state: int) -> int | None:
    if initial == "s":
        return SYSTEM if state == START else None
    due = DUE[state]
    return due if initial == ROLES[due][0] else None


@cache
def costs_before(after: Vector, code: str) -> Vector:
    """Least cost from each state before a row, where ``after`` has those after it."""
    own = [min(cost for _, cost, _ in _edits(after, code, state)) for state in range(4)]
    user = min(own[USER], INSERT + own[ASSISTANT])
    assistant = min(own[ASSISTANT], INSERT + own[USER])
    return (min(own[START], INSERT + user), min(own[SYSTEM], INSERT + user), user, assistant)


def _edits(after: Vector, code: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost from here on, next state) of the edits of the row itself."""
    fault, initial = _parts(code)
    found = [("D", DELETE + after[state], state)]
    if fault not in ("blank", "duplicate"):
        extra = TRUNCATED if fault == "truncated" else 0
        kept = _kept_state(initial, state)
        if kept is not None:
            found.append(("K", KEEP + extra + after[kept], kept))
        found.append(("R", REROLE + extra + after[DUE[state]], DUE[state]))
    return found


@cache
def traced(after: Vector, code: str, state: int) -> tuple[str, int]:
    """The edits at one row, least by letter among the cheapest, and the state they lead to."""
    before, letters = costs_before(after, code), ""
    while True:
        options = [*_edits(after, code, state), ("I", INSERT + before[DUE[state]], DUE[state])]
        letter, _, state = min(o for o in options if o[1] == before[state])
        letters += letter
        if letter != "I":
            return letters, state


@cache
def _relative(vector: Vector) -> Vector:
    least = min(vector)
    return tuple(x - least for x in vector)


def run_back(codes: str, end: Vector, known: list[Vector] | None = None) -> list[Vector]:
    """Vectors, each less its minimum, before every row and after the last one.

    With the ``known`` vectors of an earlier run it stops where they differ by a constant.
    """
    found = list(known) if known else [ANY] * (len(codes) + 1)
    found[-1] = vector = _relative(end)
    for row in range(len(codes) - 1, -1, -1):
        vector = _relative(costs_before(vector, codes[row]))
        if known and known[row] == vector:
            break
        found[row] = vector
    return found


def trace(codes: str, vectors: list[Vector], state: int) -> tuple[str, int]:
    """The edits of all rows from ``state`` on, and the state after them."""
    letters = []
    for row, code in enumerate(codes):
        edits, state = traced(vectors[row + 1], code, state)
        letters.append(edits)
    return "".join(letters), state


def _pack(vectors: list[Vector]) -> bytes:
    return bytes(x for v in vectors for x in v)


def _unpack(raw: bytes) -> list[Vector]:
    return [tuple(raw[at : at + 4]) for at in range(0, len(raw), 4)]


def _coded(table: DataFrame) -> DataFrame:
    """``(conv, chunk, codes)``: the rows of each chunk, a letter each, in order.

    A row is a duplicate unless it is the first of its role and text; the first ones are
    partial minima and come back by their own number, so no text's rows meet in one task.
    """
    firsts = table.filter("not blank").groupBy("conv", "role", "mark").agg(F.min("idx").alias("_first"))
    rows = table.join(firsts.select("_first"), F.col("idx") == F.col("_first"), "left")
    fault = (
        F.when(F.col("blank"), 1).when(F.col("_first").isNull(), 2).when(F.col("cut"), 3).otherwise(0)
    )
    initial = F.greatest(F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1, F.lit(0))
    initial = F.when(F.col("role") == "", 0).otherwise(initial)
    code = F.char(F.lit(65) + 4 * fault + initial)
    rows = rows.select("conv", "idx", F.expr(f"idx div {CHUNK}").alias("chunk"), code.alias("code"))
    lists = F.array_sort(F.collect_list(F.struct("idx", "code")))
    codes = F.array_join(F.transform(lists, lambda r: r["code"]), "")
    return rows.groupBy("conv", "chunk").agg(codes.alias("codes"))


def _next_to(chunks: DataFrame, columns: list[Column], by: int) -> DataFrame:
    """``chunks`` with ``columns`` of the chunk ``by`` numbers on, null where there is none."""
    other = chunks.select(
        F.col("conv").alias("_conv"), (F.col("chunk") - by).alias("_chunk"), *columns
    )
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk"))
    return chunks.join(other, same, "left").drop("_conv", "_chunk")


def _mapped(table: DataFrame, function, schema: str) -> DataFrame:
    """The rows that ``function`` makes of each row of ``table``, all as dictionaries."""
    names = [part.split()[0] for part in schema.split(", ")]
    own = table.schema["conv"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [out for row in batch.to_pylist() for out in function(row)]
            if rows:
                conv = batch.schema.field("conv").type
                kind = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}
                types = [conv if p.split()[0] == "conv" else kind[p.split()[1]] for p in schema.split(", ")]
                columns = [pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return table.mapInArrow(work, schema.replace("conv -", f"conv {own}"))


_CHAIN = "conv -, chunk long, codes string, last int, entry binary, start binary, vectors binary"


def _speculated(row: dict) -> list[dict]:
    """The first run of a chunk: from the end, or from nothing known."""
    vectors = run_back(row["codes"], END if row["last"] else ANY)
    return [row | _vectors(vectors)]


def _vectors(vectors: list[Vector]) -> dict:
    return {"entry": _pack(vectors[-1:]), "start": _pack(vectors[:1]), "vectors": _pack(vectors)}


def _fixed(row: dict) -> list[dict]:
    if row["next"] is not None and row["next"] != row["entry"]:
        vectors = run_back(row["codes"], _unpack(row["next"])[0], _unpack(row["vectors"]))
        row |= _vectors(vectors)
    return [row]


def _converged(chains: DataFrame) -> tuple[DataFrame, str, int]:
    """Chunks with their vectors right up to a constant; their path, and the passes it took."""
    chains, path = written(_mapped(chains, _speculated, _CHAIN), "chains")
    passes = 0
    while True:
        told = _next_to(chains, [F.col("start").alias("next")], 1)
        if told.filter("next <> entry").isEmpty():
            return chains, path, passes
        chains, new_path = written(_mapped(told, _fixed, _CHAIN), "chains")
        drop_table(chains.sparkSession, path)
        path, passes = new_path, passes + 1


def _exits(row: dict) -> list[dict]:
    vectors = _unpack(row["vectors"])
    ends = "".join(str(trace(row["codes"], vectors, s)[1]) for s in range(4))
    return [{"conv": row["conv"], "chunk": row["chunk"], "exits": ends}]


def _through(state: int, exits: list[str]) -> list[int]:
    """The states in which each of consecutive chunks is entered, and the last one's exit."""
    states = [state]
    for one in exits:
        states.append(int(one[states[-1]]))
    return states


def _entries(maps: DataFrame) -> DataFrame:
    """``(conv, chunk, entry)`` from ``(conv, chunk, exits)``: blocks of chunks, then theirs."""
    parts = F.array_sort(F.collect_list(F.struct("chunk", "exits")))
    grouped = maps.groupBy("conv", F.expr(f"chunk div {FAN}").alias("block")).agg(parts.alias("parts"))

    def spread(row: dict) -> list[dict]:
        states = _through(row["entry"], [p["exits"] for p in row["parts"]])
        return [
            {"conv": row["conv"], "chunk": p["chunk"], "entry": s}
            for p, s in zip(row["parts"], states, strict=False)
        ]

    def composed(row: dict) -> list[dict]:
        exits = [p["exits"] for p in row["parts"]]
        ends = "".join(str(_through(s, exits)[-1]) for s in range(4))
        return [{"conv": row["conv"], "chunk": row["block"], "exits": ends}]

    if maps.filter(F.col("chunk") >= FAN).isEmpty():
        entered = grouped.withColumn("entry", F.lit(START))
    else:
        blocks_of = _entries(_mapped(grouped, composed, "conv -, chunk long, exits string"))
        above = blocks_of.select(F.col("conv").alias("_conv"), F.col("chunk").alias("_block"), "entry")
        same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
        entered = grouped.join(above, same).drop("_conv", "_block")
    return _mapped(entered, spread, "conv -, chunk long, entry int")


def _audited(row: dict) -> list[dict]:
    vectors = _unpack(row["vectors"])
    letters, state = trace(row["codes"], vectors, row["entered"])
    if row["last"]:
        letters += "I" * (END[state] // INSERT)
    return [{k: row[k] for k in ("conv", "chunk", "codes")} | {"audit": letters}]


def _audited_alone(row: dict) -> list[dict]:
    vectors = run_back(row["codes"], END)
    return _audited(row | {"vectors": _pack(vectors), "entered": START, "last": 1})


_AUDIT = "conv -, chunk long, codes string, audit string"


def audits(table: DataFrame) -> DataFrame:
    """``(conv, chunk, codes, audit)`` of all chunks of ``(conv, idx, role, mark, blank, cut)``."""
    chunks, _ = written(_coded(table), "chunks")
    there = [F.lit(True).alias("_there")]
    known = _next_to(chunks, there, 1).withColumnRenamed("_there", "_after")
    known = known.join(
        chunks.select(F.col("conv").alias("_conv"), (F.col("chunk") + 1).alias("_chunk"), F.lit(True).alias("_before")),
        F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk")),
        "left",
    ).drop("_conv", "_chunk")
    known, _ = written(known, "chunks")
    alone = known.filter("_after IS NULL AND _before IS NULL").select("conv", "chunk", "codes")
    found = _mapped(alone, _audited_alone, _AUDIT)
    several = known.filter("_after IS NOT NULL OR _before IS NOT NULL")
    if several.isEmpty():
        return found
    last = F.col("_after").isNull().cast("int").alias("last")
    chains, _, _ = _converged(several.select("conv", "chunk", "codes", last))
    maps, _ = written(_mapped(chains, _exits, "conv -, chunk long, exits string"), "exits")
    entries = _entries(maps).select(
        F.col("conv").alias("_conv"), F.col("chunk").alias("_chunk"), F.col("entry").alias("entered")
    )
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk"))
    return found.unionByName(_mapped(chains.join(entries, same), _audited, _AUDIT))


@dataclass
class Conversation:
    """What is known of one conversation while its rows pass."""

    conv: object
    codes: str = ""
    audit: str = ""
    row: int = 0
    at: int = 0
    position: int = 0
    state: int = START

    def _inserted(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = DUE[self.state]
            self.at += 1
            yield self._out(ROLES[self.state], "", "I", None)

    def _out(self, role: str, text: str, edit: str, turn) -> tuple:
        self.position += 1
        return (self.conv, self.position - 1, role, text, edit, turn)

    def take(self, role: str, text: str, turn) -> Iterator[tuple]:
        """The repaired rows that come of one row: inserted ones before it, and itself."""
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        self.row += 1
        if edit == "R":
            self.state = DUE[self.state]
            yield self._out(ROLES[self.state], text, edit, turn)
        elif edit == "K":
            self.state = _kept_state(role[:1], self.state)
            yield self._out(role, text, edit, turn)

    def end(self) -> Iterator[tuple]:
        yield from self._inserted()

    def cost(self) -> int:
        total, row = 0, 0
        for letter in self.audit:
            total += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[letter]
            if letter != "I":
                fault = _parts(self.codes[row])[0]
                total += TRUNCATED if letter != "D" and fault == "truncated" else 0
                row += 1
        return total

    def faults(self) -> list[int]:
        return [sum(_parts(c)[0] == fault for c in self.codes) for fault in FAULTS[1:]]


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Conversation, dict | None]]:
    """Each text row with its conversation, then the conversation without a row."""
    now: Conversation | None = None
    for table in blocks(batches, "text"):
        for row in table.to_pylist():
            if now is None or row["conv"] != now.conv:
                if now is not None:
                    yield now, None
                now = Conversation(row["conv"])
            if row["chunk"] is not None:
                now.codes += row["codes"]
                now.audit += row["audit"]
            else:
                yield now, row
    if now is not None:
        yield now, None


class Repair:
    """The cheapest repair of every conversation of ``rows``.

    A conversation is all rows of one ``conv`` (a null one is a conversation too), by ``turn``,
    null turns first; rows of the same turn go by role and then by the MD5 of their text, so
    repeated rows are neighbours. A null role or text counts as one blank. A row is blank
    without any character but ASCII white space, else a duplicate if its role and text stand
    earlier in its conversation, else truncated if its last such character is none of ``.!?``.
    Blank and duplicate rows have to go. The initial of a role counts: s, u, a, or none of them.
    Texts are worked on whole, whatever their length; an empty table has no conversations.
    Other columns are not read.

    Codes, costs and edits of a long conversation are worked on in chunks by many tasks. Texts
    are only put in order, a partition streaming its conversations one row at a time: a
    conversation's rows have to pass one task in order for any digest of the whole of it.
    """

    def __init__(
        self, rows: DataFrame, conv: str = "conv_id", turn: str = "turn",
        role: str = "role", text: str = "text",
    ):
        self.name = conv
        blank = F.lit(" ")
        source = rows.select(
            F.col(conv).alias("conv"), F.col(turn).alias("turn"),
            F.coalesce(F.col(role), blank).alias("role"), F.coalesce(F.col(text), blank).alias("text"),
        ).withColumn("mark", F.md5("text"))
        bare = F.rtrim("text", F.lit(BLANKS))
        ended = F.substring(bare, -1, 1).isin(".", "!", "?")
        slim = source.select(
            "conv", "turn", "role", "mark", (bare == "").alias("blank"), (~ended).alias("cut"),
            F.monotonically_increasing_id().alias("tie"),
        )
        order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "mark", "tie"]
        order = [F.col(o) if isinstance(o, str) else o for o in order]
        self.audits, self.path = written(audits(with_index(slim, order)), "audits")
        kinds = {f.name: f.dataType.simpleString() for f in source.schema}
        self.kinds = kinds
        texts = source.selectExpr("*", "CAST(NULL AS BIGINT) AS chunk", "'' AS codes", "'' AS audit")
        nothing = [f"CAST(NULL AS {kinds['turn']}) AS turn", "'' AS role", "'' AS text", "'' AS mark"]
        known = self.audits.selectExpr("conv", *nothing, "chunk", "codes", "audit")
        self.stream = (
            texts.unionByName(known)
            .repartition("conv")
            .sortWithinPartitions(
                F.asc_nulls_first("conv"), F.asc_nulls_last("chunk"), F.asc_nulls_first("turn"), "role", "mark"
            )
            .drop("mark")
        )

    def rows(self) -> DataFrame:
        """``(conv, position, role, text, edit, turn)`` of the repaired conversations.

        edit: K for a row kept as it is, R for one with a new role, I for an inserted one.
        """
        kind, turn = self.kinds["conv"], self.kinds["turn"]

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0

            def out() -> pa.RecordBatch:
                names = ["conv", "position", "role", "text", "edit", "turn"]
                conv_type, turn_type = arrow_types(kind), arrow_types(turn)
                types = [conv_type, pa.int64(), pa.string(), pa.string(), pa.string(), turn_type]
                columns = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)]
                return pa.RecordBatch.from_arrays(columns, names)

            for now, row in _conversations(batches):
                made = now.end() if row is None else now.take(row["role"], row["text"], row["turn"])
                for one in made:
                    held.append(one)
                    size += len(one[3])
                if size > 1 << 20 or len(held) > 10_000:
                    yield out()
                    held, size = [], 0
            if held:
                yield out()

        schema = f"conv {kind}, position bigint, role string, text string, edit string, turn {turn}"
        return self.stream.mapInArrow(work, schema).withColumnRenamed("conv", self.name)

    def report(self) -> DataFrame:
        """One row per conversation: what was wrong, the cheapest edits and a digest.

        ``gaps`` (last turn - first turn + 1 - distinct turns, without null ones), ``blank``,
        ``duplicate``, ``truncated`` (rows by their first fault), ``illegal`` (neighbours whose
        initials are none of su, ua, au), ``cost``, ``audit`` (the edits' initials in order,
        least by letter of all cheapest ones) and ``repaired_sha256`` (of role:text of the
        repaired rows, joined by line feeds).
        """
        kind = self.kinds["conv"]

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["conv", *(n for n, _ in REPORT)]
            types = [arrow_types(kind), *(pa.string() if t == "string" else pa.int64() for _, t in REPORT)]
            held: list[list] = []

            def out() -> pa.RecordBatch:
                columns = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)]
                return pa.RecordBatch.from_arrays(columns, names)

            whole, last, turns, low, high, illegal = hashlib.sha256(), None, 0, None, None, 0
            for now, row in _conversations(batches):
                made = now.end() if row is None else now.take(row["role"], row["text"], row["turn"])
                for one in made:
                    whole.update(("\n" * (one[1] > 0) + f"{one[2]}:{one[3]}").encode())
                if row is not None:
                    initial = row["role"][:1]
                    illegal += last is not None and last + initial not in ("su", "ua", "au")
                    last = initial
                    if row["turn"] is not None:
                        turns += row["turn"] != high
                        low = row["turn"] if low is None else low
                        high = row["turn"]
                    continue
                gaps = high - low + 1 - turns if turns else 0
                held.append(
                    [now.conv, gaps, *now.faults(), illegal, now.cost(), now.audit, whole.hexdigest()]
                )
                whole, last, turns, low, high, illegal = hashlib.sha256(), None, 0, None, None, 0
                if len(held) >= 1000:
                    yield out()
                    held.clear()
            if held:
                yield out()

        schema = ", ".join([f"conv {kind}", *(f"{n} {t}" for n, t in REPORT)])
        return self.stream.mapInArrow(work, schema).withColumnRenamed("conv", self.name)


REPORT = [
    ("gaps", "bigint"), ("blank", "bigint"), ("duplicate", "bigint"), ("truncated", "bigint"),
    ("illegal", "bigint"), ("cost", "bigint"), ("audit", "string"), ("repaired_sha256", "string"),
]


def arrow_types(kind: str) -> pa.DataType:
    """The Arrow type of a key or turn."""
    known = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "string": pa.string()}
    return known[kind]


def damaged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with faults put in by the CRC32 of ``conv_id:turn``.

    Of twenty remainders 0 drops a row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats
    the row and 4 makes its role user. Nulls are one blank, but for a row's own id and turn.
    """
    blank = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), blank),
    )
    part = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    text = F.when(F.col("part") == 1, "").when(F.col("part") == 2, F.translate(text, ".!?", "")).otherwise(text)
    times = F.when(F.col("part") == 3, 2).otherwise(1)
    return (
        rows.select("conv_id", "turn", "role", "text", part.alias("part"))
        .filter("part <> 0")
        .select(
            "conv_id", "turn", F.when(F.col("part") == 4, "user").otherwise(role).alias("role"),
            text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_copy"),
        )
        .drop("_copy")
    )
