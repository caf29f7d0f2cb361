"""Documents packed into training sequences, online, by the sum of squares.

A document is cut into whole windows; what is left of it goes to the fill level that makes
the sum of the squared counts of partially filled windows smallest, which keeps the levels
spread so that a later rest finds a window it completes. The counts are an array over the
levels. Each task packs its own rows: nothing is shuffled. Windows still open at the end
of a task fill each other up by cutting; what is left at last is shorter than a window and
goes out in sequences of powers of two, so no sequence is padded. Beyond ``max_open`` open
windows the fullest is completed from the emptiest ones, which bounds what a task holds.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.words import LOWER, VISIBLE, blocks, number_pieces, release, text_bytes

CAPACITY = 2048
END_ID = 1
MAX_OPEN = 2048
TOKENIZER = "word_bpe_49k.json"
#: Bytes of text encoded at a time, and of the pieces remembered in each of two generations.
BLOCK = 1 << 20
REMEMBERED = 12 << 20

#: Classes of bytes of a lower-cased text; ODD ones need the whole tokenizer.
SPACE, LETTER, DIGIT, OTHER, ODD = range(5)
_ASCII = np.full(256, ODD, dtype=np.uint8)
_ASCII[33:127] = OTHER
_ASCII[~VISIBLE] = SPACE
_ASCII[48:58] = DIGIT
_ASCII[97:123] = LETTER
_ASCII[39] = ODD  # begins 's and the like
#: Second bytes after 0xC2 and 0xC3: U+0080 to U+00FF.
_AFTER_C2 = np.full(256, ODD, dtype=np.uint8)
_AFTER_C2[0xA1:0xC0] = OTHER
_AFTER_C2[[0xAA, 0xB5, 0xBA]] = LETTER
_AFTER_C2[[0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = ODD
_AFTER_C3 = np.full(256, ODD, dtype=np.uint8)
_AFTER_C3[0x80:0xC0] = LETTER
_AFTER_C3[[0x97, 0xB7]] = OTHER


def classify(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with letters up to U+00FF in lower case, and the class of each."""
    data = LOWER[data]
    kind = _ASCII[data]
    for lead, table in ((0xC2, _AFTER_C2), (0xC3, _AFTER_C3)):
        at = np.flatnonzero(data[:-1] == lead)
        kind[at] = kind[at + 1] = table[data[at + 1]]
        if lead == 0xC3:
            upper = at[(data[at + 1] < 0x9F) & (data[at + 1] != 0x97)] + 1
            data[upper] += 0x20
    return data, kind


class Encoder:
    """Token ids of many texts; a piece between two breaks is encoded once and remembered.

    White space never is part of a token and nothing composes across it. Between white
    space, runs of letters and of signs up to U+00FF are parted here as the tokenizer does
    and digits stand alone; each piece goes to the tokenizer's own model. A chunk with an
    apostrophe or any other character goes through the whole tokenizer. A special token of
    the file written out in a text is that token, as the tokenizer has it, and parts what
    stands before and after it.
    """

    def __init__(self, path: str | None = None, limit: int = REMEMBERED):
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError("special tokens that take white space or normal forms are not supported")
        self.special = {t.content.encode(): array("I", [n]).tobytes() for n, t in added.items()}
        longest = sorted(self.special, key=len, reverse=True)
        self.marks = re.compile(b"|".join(map(re.escape, longest))) if longest else None
        # Special tokens are taken out of a text before it is lower-cased; in what is left,
        # which is in lower case already, none may be found.
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.limit, self.held = limit, 0
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = {b: chr(b) for b in shown} | {
            b: chr(256 + k) for k, b in enumerate(hidden)
        }

    def _encode(self, piece: bytes, plain: bool) -> bytes:
        if piece in self.special:
            return self.special[piece]
        if not plain:
            ids = self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids
        elif piece.isascii():
            ids = [t.id for t in self.model.tokenize(piece.decode())]
        else:
            text = "".join(map(self.letters.__getitem__, piece))
            ids = [t.id for t in self.model.tokenize(text)]
        return array("I", ids).tobytes()

    def _remembered(self, piece: bytes, plain: bool) -> bytes:
        ids = self.young.get(piece)
        if ids is None:
            ids = self.old.get(piece) or self._encode(piece, plain)
            # Two bytes objects and their place in the table.
            self.held += len(piece) + len(ids) + 170
            if self.held > self.limit:
                self.old, self.young, self.held = self.young, {}, 0
            self.young[piece] = ids
        return ids

    def _written_out(self, data: np.ndarray, begins: np.ndarray) -> list[tuple[int, int]]:
        """Where special tokens stand in the texts."""
        raw = data.tobytes()
        if self.marks is None or not self.marks.search(raw):
            return []
        texts = zip(begins.tolist(), begins[1:].tolist(), strict=False)
        return [m.span() for a, b in texts for m in self.marks.finditer(raw, a, b)]

    def _pieces(self, data: np.ndarray, begins: np.ndarray):
        """Bytes, starts and ends of all pieces, and which of them are plain."""
        special = self._written_out(data, begins)
        raw = data
        data, kind = classify(data)
        for start, end in special:
            data[start:end], kind[start:end] = raw[start:end], OTHER
        solid = kind != SPACE
        chunk = np.ones(len(data), dtype=bool)
        chunk[1:] = ~solid[:-1]
        chunk[begins[begins < len(data)]] = True
        edges = np.array([x for span in special for x in span], dtype=np.int64)
        chunk[edges[edges < len(data)]] = True
        chunk &= solid
        number = np.cumsum(chunk)
        odd = np.zeros(int(number[-1]) + 1 if len(data) else 1, dtype=bool)
        odd[number[kind == ODD]] = True
        plain = ~odd[number]
        new = np.ones(len(data), dtype=bool)
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        new &= plain
        for start, end in special:
            new[start:end] = False
        new |= chunk
        new &= solid
        starts = np.flatnonzero(new)
        stop = np.append(new[1:] | ~solid[1:], True) if len(data) else new
        stop &= solid
        return data, starts, np.flatnonzero(stop) + 1, plain[starts], solid

    def encode(self, column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array and where each text begins in it."""
        data, begins = text_bytes(column)
        data, starts, ends, plain, solid = self._pieces(data, begins)
        codes, distinct = number_pieces(data[solid], ends - starts)
        kind = np.zeros(len(distinct), dtype=bool)
        kind[codes] = plain
        found = list(map(self._remembered, distinct, kind.tolist()))
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        begin = np.concatenate([[0], np.cumsum(lengths)])
        size = lengths[codes]
        after = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(after[-1]) - np.repeat(after[:-1] - begin[codes], size)
        return flat[at], after[np.searchsorted(starts, begins)]



class Packer:
    """Fill levels of the open windows of one task."""

    def __init__(self, capacity: int, max_open: int):
        self.capacity, self.max_open = capacity, max_open
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        self.levels: dict[int, list[list]] = {}
        self.open = 0

    def place(self, rest: tuple) -> list[list]:
        """Puts a rest (row, start, ids) into a window; windows that are complete."""
        size, full = len(rest[2]), self.capacity
        # What the sum of squares grows by at each level; level 0 is a new window.
        below = self.counts[: full - size]
        cost = 2 * (self.counts[size:full] - below + 1)
        cost = np.where(below > 0, cost, np.iinfo(np.int64).max)
        cost[0] = 2 * self.counts[size] + 1
        level = full - size - 1 - int(np.argmin(cost[::-1]))
        last = self.counts[full - size]
        if last and 1 - 2 * last <= cost[level]:
            level = full - size
        window = []
        if level:
            window = self._taken(level)
        window.append(rest)
        if level + size == full:
            return [window]
        self._put(level + size, window)
        return self._relieve() if self.open > self.max_open else []

    def _taken(self, level: int) -> list:
        self.counts[level] -= 1
        self.open -= 1
        return self.levels[level].pop()

    def _put(self, level: int, window: list) -> None:
        self.levels.setdefault(level, []).append(window)
        self.counts[level] += 1
        self.open += 1

    def _relieve(self) -> list[list]:
        """Completes the fullest window from the emptiest; the others stay as they are."""
        level = int(np.flatnonzero(self.counts)[-1])
        window = self._taken(level)
        while level < self.capacity and self.open:
            low = int(np.flatnonzero(self.counts)[0])
            spare = self._taken(low)
            while spare and level < self.capacity:
                row, start, ids = spare.pop()
                gap = self.capacity - level
                window.append((row, start, ids[:gap]))
                if len(ids) > gap:
                    spare.append((row, start + gap, ids[gap:]))
                taken = len(window[-1][2])
                level, low = level + taken, low - taken
            if spare:
                self._put(low, spare)
        if level < self.capacity:
            self._put(level, window)
            return []
        return [window]

    def close(self) -> list[list]:
        """Completes the open windows from each other; the last goes out in powers of two."""
        windows = [(n, w) for n in sorted(self.levels, reverse=True) for w in self.levels[n]]
        self.counts[:] = 0
        self.levels, self.open = {}, 0
        done, low = [], len(windows) - 1
        spare: list = []
        for high, (level, window) in enumerate(windows):
            if high > low:
                break
            gap = self.capacity - level
            while gap:
                if not spare:
                    if low <= high:
                        break
                    spare = windows[low][1]
                    low -= 1
                row, start, ids = spare.pop()
                window.append((row, start, ids[:gap]))
                if len(ids) > gap:
                    spare.append((row, start + gap, ids[gap:]))
                gap -= len(window[-1][2])
            if gap:
                done += self._powers(window)
            else:
                done.append(window)
        if spare:
            done += self._powers(spare)
        return done

    @staticmethod
    def _powers(pieces: list) -> list[list]:
        left = sum(len(ids) for _, _, ids in pieces)
        pieces, out = pieces[::-1], []
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            window = []
            while size:
                row, start, ids = pieces.pop()
                window.append((row, start, ids[:size]))
                if len(ids) > size:
                    pieces.append((row, start + size, ids[size:]))
                size -= len(window[-1][2])
            out.append(window)
        return out


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    with_ids: bool = False,
    max_open: int = MAX_OPEN,
) -> DataFrame:
    """One row per piece of a document and the sequence it lies in.

    ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, on demand, the
    ids themselves. A document is its ids and the end id; a null text counts as empty and
    is one end id. Every id of every row lies in one piece; a repeated row or key is packed
    again, and other columns are not read. A sequence is full or as long as a power of two.
    A task keeps at most ``max_open`` windows open, of ``capacity`` ids at most.
    ``sequence_id`` is the task's number times 2^40 plus a count, so the same input split
    gives the same sequences again. An empty table gives no rows.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer = Encoder(tokenizer), Packer(capacity, max_open)
        sequence = TaskContext.get().partitionId() << 40
        columns: list[list] = [[] for _ in range(7 + with_ids)]

        def emit(window: list) -> None:
            nonlocal sequence
            offset = 0
            for (name, total), start, ids in window:
                row = [name, start, len(ids), zlib.crc32(ids), total, sequence, offset]
                for column, value in zip(columns, [*row, ids] if with_ids else row, strict=True):
                    column.append(value)
                offset += len(ids)
            sequence += 1

        def out(key_type: pa.DataType) -> pa.RecordBatch:
            types = [key_type, *[pa.int64()] * 6, *[pa.list_(pa.int64())] * with_ids]
            arrays = [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)]
            for column in columns:
                column.clear()
            names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.record_batch(arrays, [*names, *["ids"] * with_ids])

        key_type = None
        for table in blocks(batches, "text", BLOCK):
            key_type = table.schema.field("key").type
            ids, begins = coder.encode(table["text"])
            for i, name in enumerate(table["key"].to_pylist()):
                own = np.append(ids[begins[i] : begins[i + 1]], np.uint32(END_ID)).astype("<u4")
                row = (name, len(own))
                whole = len(own) - len(own) % capacity
                for start in range(0, whole, capacity):
                    emit([(row, start, own[start : start + capacity])])
                if whole < len(own):
                    for window in packer.place((row, whole, own[whole:].copy())):
                        emit(window)
            yield out(key_type)
        del coder
        if key_type is not None:
            for window in packer.close():
                emit(window)
            yield out(key_type)
        release()

    schema = f"key {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    schema += "sequence_id bigint, offset bigint" + ", ids array<bigint>" * with_ids
    return source.mapInArrow(work, schema).withColumnRenamed("key", key)
