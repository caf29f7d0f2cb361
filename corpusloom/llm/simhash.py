"""SimHash fingerprints, and groups of documents whose fingerprints nearly agree.

Links are found by meeting in the middle of a Hamming ball. Two fingerprints three bits
apart have no common middle at a whole radius, so the odd step is taken by setting one of
four 16-bit blocks aside: at least one block holds an odd number of the differing bits, and
what is left of the difference outside it is two bits or none. Every distinct fingerprint
emits, for each block, the other 48 bits and their 48 one-bit variants (196 rows, whatever
the data). All that meet in one variant are at most two bits apart outside the block, so
inside a bucket it is enough to compare the block values:

* same value: linked through one hub, no pairs are made;
* values one bit apart: linked (2 + 1 bits);
* values three bits apart, both fingerprints unchanged outside the block: linked (0 + 3).

Differences of one or two bits, or of three over several blocks, show up in the first two
cases under another block. A bucket has at most 65,536 block values, each looked up under
its 16 (or 560) neighbours, and every link is verified on the whole fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.graph import components
from corpusloom.llm.store import drawn, drop_table, sample_share, size_on_disk, written
from corpusloom.llm.words import LOWER, VISIBLE, Words, blocks, mix, text_bytes

SEED = 42
RADIUS = 3
BLOCK_BITS = 16
_ONE = np.uint64(1)


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every run of ``size`` words joined by blanks, and their number per text.

    A text of fewer words has one run, its whole sequence; a text without words none.
    """
    lengths = words.ends - words.starts
    begin = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(lengths + 1, out=begin[1:])
    joined = np.full(begin[-1], 32, dtype=np.uint8)
    letters = np.ones(begin[-1], dtype=bool)
    letters[begin[1:] - 1] = False
    joined[letters] = words.data[words._inside]
    raw = joined.tobytes()

    n = words.counts
    runs = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    before = np.concatenate([[0], np.cumsum(runs)])
    text = np.repeat(np.arange(len(n)), runs)
    head = words.first[text] + np.arange(before[-1]) - before[text]
    last = head + np.minimum(size, n[text]) - 1
    digest = xxhash.xxh64_intdigest
    pieces = zip(begin[head].tolist(), (begin[last] + lengths[last]).tolist(), strict=True)
    hashes = np.fromiter(
        (digest(raw[a:b], SEED) for a, b in pieces), dtype=np.uint64, count=before[-1]
    )
    return hashes, runs


def majority_bits(hashes: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """For each text the bits that over half of its hashes have; zero without hashes.

    Eight one-byte counters share a 64-bit sum, over at most 255 hashes at a time.
    """
    out = np.zeros(len(runs), dtype=np.uint64)
    full = np.flatnonzero(runs)
    if not len(full):
        return out
    n = runs[full]
    parts = -(-n // 255)
    part_of = np.concatenate([[0], np.cumsum(parts)])
    starts = np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), parts) + 255 * (
        np.arange(part_of[-1]) - np.repeat(part_of[:-1], parts)
    )
    lanes = np.uint64(0x0101010101010101)
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & lanes, starts)
        counts = np.add.reduceat(
            sums.view(np.uint8).reshape(-1, 8).astype(np.int64), part_of[:-1], axis=0
        )
        for lane in range(8):
            out[full] |= (2 * counts[:, lane] > n).astype(np.uint64) << np.uint64(8 * lane + bit)
    return out


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3
) -> DataFrame:
    """``(key, fingerprint)``: one signed 64-bit SimHash per row.

    A-Z are lower-cased, words are parted by ASCII white space. A null or empty text, or
    one of white space only, gets fingerprint zero. Other columns are not read.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, "text"):
            words = Words(*text_bytes(table["text"]), VISIBLE, LOWER)
            bits = majority_bits(*shingle_hashes(words, shingle)).view(np.int64)
            made = pa.table({"key": table["key"], "fingerprint": pa.array(bits)})
            yield from made.to_batches()

    kind = source.schema["key"].dataType.simpleString()
    made = source.mapInArrow(work, f"key {kind}, fingerprint bigint")
    return made.withColumnRenamed("key", key)


def _variants() -> list[tuple[int, int, int]]:
    """(block, bits kept, bit flipped) of the 196 rows that a fingerprint emits."""
    rows = []
    for block in range(64 // BLOCK_BITS):
        aside = ((1 << BLOCK_BITS) - 1) << (BLOCK_BITS * block)
        keep = ~aside & (2**64 - 1)
        rows.append((block, keep, 0))
        rows += [(block, keep, 1 << bit) for bit in range(64) if keep >> bit & 1]
    return rows


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def _near_values(bucket: np.ndarray, value: np.ndarray, distance: int):
    """Index pairs of values ``distance`` bits apart within one bucket."""
    at = bucket.astype(np.int64) << BLOCK_BITS | value
    order = np.argsort(at)
    ranked = at[order]
    for bits in combinations(range(BLOCK_BITS), distance):
        flip = sum(1 << b for b in bits)
        high = np.flatnonzero(value >> bits[-1] & 1)
        wanted = at[high] ^ flip
        place = np.minimum(np.searchsorted(ranked, wanted), len(ranked) - 1)
        hit = ranked[place] == wanted
        yield high[hit], order[place[hit]]


def _links(block: np.ndarray, key: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Linked pairs among rows sorted by (block, key), without making all pairs."""
    start = np.ones(len(key), dtype=bool)
    start[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
    bucket = np.cumsum(start)
    several = np.bincount(bucket)[bucket] > 1
    if not several.any():
        return np.zeros((0, 2), dtype=np.uint64)
    block, key, fp, bucket = block[several], key[several], fp[several], bucket[several]
    shift = (BLOCK_BITS * block).astype(np.uint64)
    value = (fp >> shift & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
    as_is = (key ^ fp) >> shift >> np.uint64(BLOCK_BITS) == 0
    as_is &= ((key ^ fp) & ((_ONE << shift) - _ONE)) == 0

    order = np.lexsort((fp, value, bucket))
    bucket, value, fp, as_is = bucket[order], value[order], fp[order], as_is[order]
    head = np.ones(len(fp), dtype=bool)
    head[1:] = (bucket[1:] != bucket[:-1]) | (value[1:] != value[:-1])
    hub = fp[np.flatnonzero(head)[np.cumsum(head) - 1]]
    found = [np.stack([fp[~head], hub[~head]], axis=1)]

    def near(chosen: np.ndarray, distance: int) -> None:
        mine = fp[chosen]
        for left, right in _near_values(bucket[chosen], value[chosen], distance):
            found.append(np.stack([mine[left], mine[right]], axis=1))

    near(np.flatnonzero(head), 1)
    still = np.flatnonzero(as_is)
    shared = np.bincount(bucket[still], minlength=bucket[-1] + 1)[bucket[still]] > 1
    if shared.any():
        near(still[shared], 3)
    pairs = np.concatenate(found)
    apart = pairs[:, 0] ^ pairs[:, 1]
    pairs = pairs[(np.bitwise_count(apart) <= RADIUS) & (apart != 0)]
    return np.unique(pairs, axis=0) if len(pairs) else pairs


def links(prints: DataFrame) -> DataFrame:
    """``(a, b)``: enough true links between distinct fingerprints to connect every group.

    ``prints`` holds one bigint column ``fingerprint`` of distinct values. Any two within
    three differing bits are linked directly or through others that are.
    """
    rows = ", ".join(
        f"named_struct('block', {b}, 'keep', {_signed(k)}L, 'flip', {_signed(f)}L)"
        if _signed(f) != -(2**63)
        else f"named_struct('block', {b}, 'keep', {_signed(k)}L, 'flip', shiftleft(1L, 63))"
        for b, k, f in _variants()
    )
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variant = F.explode(F.expr(f"array({rows})")).alias("v")
    key = F.col("fingerprint").bitwiseAND(F.col("v.keep")).bitwiseXOR(F.col("v.flip"))
    emitted = (
        # A few megabytes of fingerprints make gigabytes of variants: not in few tasks.
        prints.repartition(parts)
        .select("fingerprint", variant)
        .select(F.col("v.block").alias("block"), key.alias("key"), "fingerprint")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0

        def flush(last: bool):
            nonlocal held, rows
            block, key, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            stop = len(key)
            if not last:
                same = (key == key[-1]) & (block == block[-1])
                stop = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            held = [(block[stop:], key[stop:], fp[stop:])]
            rows = len(key) - stop
            pairs = _links(block[:stop], key[:stop], fp[:stop]).view(np.int64)
            return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        limit = 200_000
        for batch in batches:
            held.append(
                (
                    batch["block"].to_numpy(),
                    batch["key"].to_numpy().view(np.uint64),
                    batch["fingerprint"].to_numpy().view(np.uint64),
                )
            )
            rows += batch.num_rows
            if rows >= limit:
                yield flush(False)
                limit = 200_000 + 2 * rows
        if rows:
            yield flush(True)

    dealt = emitted.repartition("block", "key").sortWithinPartitions("block", "key")
    return dealt.mapInArrow(work, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3
) -> DataFrame:
    """``(key, fingerprint, component)`` for every row of ``docs``.

    component: the smallest key that can be reached over fingerprints of at most three
    differing bits, itself included. Repeated rows come back repeated; a null key never is
    a component and rows without any other key in reach get null. Copies share one
    fingerprint and are reduced to it before anything is compared.
    """
    prints, _ = written(fingerprints(docs, key, text, shingle), "fingerprints")
    one = prints.groupBy("fingerprint").agg(F.min(key).alias("least"))
    return _grouped(prints, one, links(one.select("fingerprint")), "fingerprint", key)


def _grouped(prints: DataFrame, one: DataFrame, edges: DataFrame, node: str, key: str):
    """``prints`` with the smallest key of its component of ``edges`` over ``node``.

    ``one`` has each node once with its smallest key as ``least``.
    """
    reached = components(edges).withColumnRenamed("node", node)
    label = reached.join(one, node).select(node, F.col("component").alias("root"), "least")
    roots = label.groupBy("root").agg(F.min("least").alias("lowest"))
    moved = label.join(roots, "root").select(node, "lowest")
    final = one.join(moved, node, "left").select(
        node, F.coalesce("lowest", "least").alias("component")
    )
    return prints.join(final, node).select(key, node, "component")


# Near duplicates by similarity of their shingles.

#: Bytes of text whose shingles are hashed at a time.
SHINGLE_BLOCK = 2 << 20
#: Documents, and shingles that several of them share, that set the order of shingles.
ORDER_DOCS, ORDER_SHINGLES = 20_000, 200_000
#: Members of a bucket up to which all of its pairs are proposed at once.
CROWDED = 16
#: Members of a crowded bucket, by place, that are compared with all later ones round by round;
#: the last round has no end, so that every pair has its turn.
HUBS = ((1, 3), (3, 9), (9, 27), (27, None))
#: Pairs that a task holds at a time.
PAIR_ROWS = 200_000
#: Dropped keys are broadcast up to this size of their table, which is checked.
BROADCAST_BYTES = 16 << 20
_SLACK = 1e-9


def _shingles(table: pa.Table, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every shingle of the column ``text``, repeats included.

    Words are as in ``fingerprints``; a text of fewer words than a shingle is one shingle,
    and a text without words has none.
    """
    words = Words(*text_bytes(table["text"]), VISIBLE, LOWER)
    codes, distinct = words.codes()
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(w, SEED) for w in distinct), np.uint64, len(distinct)
    )[codes]
    n = words.counts
    runs = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    head = np.repeat(words.first[:-1], runs) + (
        np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    )
    row = np.repeat(np.arange(table.num_rows), runs)
    length = np.minimum(shingle, n[row])
    out = np.zeros(len(head), dtype=np.uint64)
    for k in range(shingle):
        own = np.flatnonzero(length > k)
        out[own] = mix(out[own] * np.uint64(31) + hashes[head[own] + k])
    return row, out


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _common(docs: DataFrame, text: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of a sample of texts share, ascending, and by how many.

    They only order the shingles, see ``shingle_sets``: the sample bounds no result.
    """
    source = docs.select(F.col(text).alias("text"))
    share = sample_share(source.count(), ORDER_DOCS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, "text", SHINGLE_BLOCK):
            row, hashes = _shingles(table, shingle)
            order = np.lexsort((hashes, row))
            row, hashes = row[order], hashes[order]
            single = hashes[_firsts(row, hashes)].view(np.int64)
            yield pa.record_batch([pa.array(single)], ["shingle"])

    drawn_texts = source.filter(drawn(share, "text")).dropDuplicates()
    counted = drawn_texts.mapInArrow(work, "shingle bigint").groupBy("shingle").count()
    top = counted.filter("count > 2").orderBy(F.desc("count"), "shingle").limit(ORDER_SHINGLES)
    rows = top.collect()
    known = np.array([r["shingle"] for r in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(known)
    return known[order], np.array([r["count"] for r in rows], dtype=np.int64)[order]


def _parities(row: np.ndarray, hashes: np.ndarray, n: np.ndarray) -> pa.ListArray:
    """For each row a bitmap, in 64-bit words, of whether an odd number of its hashes falls on a bit.

    It has as many bits as the row has hashes, rounded up to a power of two of 64 at least; a
    hash falls on its lowest bits, so xor of the two halves gives the bitmap of half the size.
    """
    width = 1 << np.ceil(np.log2(np.maximum(n, 64))).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(width)])
    place = begin[row] + (hashes & (width[row] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(place, minlength=begin[-1]) & 1
    words = np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)
    return pa.ListArray.from_arrays(pa.array((begin // 64).astype(np.int32)), pa.array(words))


def shingle_sets(
    docs: DataFrame, key: str, text: str, shingle: int = 5, similarity: float = 0.0, common=None
) -> DataFrame:
    """``(key, node, n, bits, shingles)``: a text's n distinct hashed shingles, in one order for all.

    Shingles that are ``common`` in a sample come last, the commonest at the end, and the rest
    goes by hash. ``node`` is a hash of the set; texts without words are alike. ``bits`` are
    the parities of ``_parities``. With a similarity only the first shingles are listed, of
    which two so similar sets share one.
    """
    none = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    sent = docs.sparkSession.sparkContext.broadcast(common or none)
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = sent.value
        for table in blocks(batches, "text", SHINGLE_BLOCK):
            row, hashes = _shingles(table, shingle)
            often = np.zeros(len(hashes), dtype=np.int64)
            if len(known):
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                often = np.where(known[place] == hashes, counts[place], 0)
            order = np.lexsort((hashes, often, row))
            row, hashes = row[order], hashes[order]
            once = _firsts(row, hashes)
            row, hashes = row[once], hashes[once]
            n = np.bincount(row, minlength=table.num_rows)
            begin = np.concatenate([[0], np.cumsum(n)])
            total = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes + _ONE), dtype=np.uint64)])
            node = mix(total[begin[1:]] - total[begin[:-1]] + mix(n.astype(np.uint64)))
            bits = _parities(row, hashes, n)
            if similarity:
                most = n - np.ceil(n * similarity - _SLACK).astype(np.int64) + (n > 0)
                hashes = hashes[np.arange(len(row)) - begin[row] < most[row]]
                begin = np.concatenate([[0], np.cumsum(most)])
            lists = pa.ListArray.from_arrays(
                pa.array(begin.astype(np.int32)), pa.array(hashes.view(np.int64))
            )
            made = {"key": table["key"], "node": pa.array(node.view(np.int64))}
            made |= {"n": pa.array(n.astype(np.int32)), "bits": bits, "shingles": lists}
            yield from pa.table(made).to_batches(max_chunksize=1000)

    kind = source.schema["key"].dataType.simpleString()
    columns = f"key {kind}, node bigint, n int, bits array<bigint>, shingles array<bigint>"
    return source.mapInArrow(work, columns).withColumnRenamed("key", key)


def _whole_buckets(
    batches: Iterator[pa.RecordBatch], names: list[str]
) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by the first one, cut between its values only."""
    kept: list[list[np.ndarray]] = []
    rows, limit = 0, 200_000
    for batch in batches:
        kept.append([batch[name].to_numpy() for name in names])
        rows += batch.num_rows
        if rows >= limit:
            columns = [np.concatenate(c) for c in zip(*kept, strict=True)]
            stop = int(np.searchsorted(columns[0], columns[0][-1]))
            yield [c[:stop] for c in columns]
            kept, rows = [[c[stop:] for c in columns]], len(columns[0]) - stop
            limit = 200_000 + 2 * rows
    if rows:
        yield [np.concatenate(c) for c in zip(*kept, strict=True)]


def _may_link(n, place, left, right, similarity: float) -> np.ndarray:
    """Whether pairs can be similar enough if this is their first common shingle."""
    need = similarity / (1 + similarity) * (n[left] + n[right]) - _SLACK
    return np.minimum(n[left] - place[left], n[right] - place[right]) >= need


_MET = "a bigint, b bigint, shingle bigint, n int, place int"


def _meetings(firsts: DataFrame, similarity: float) -> DataFrame:
    """Nodes that share a shingle among the first of both: pairs, and crowded buckets.

    Rows with ``b`` are proposed pairs: all of a small bucket, and those with two members
    of a crowded one. Rows without ``b`` are the members of the crowded buckets.
    """
    emitted = firsts.select("node", "n", F.posexplode("shingles").alias("place", "shingle"))
    emitted = emitted.select("shingle", "node", "n", "place")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _whole_buckets(batches, ["shingle", "node", "n", "place"]):
            once = _firsts(*columns[:2])
            key, node, n, place = (c[once] for c in columns)
            if not len(key):
                continue
            start = np.flatnonzero(_firsts(key))
            size = np.diff(np.append(start, len(key)))
            several = np.repeat(size, size) > 1
            if not several.any():
                continue
            key, node, n, place = (c[several] for c in (key, node, n, place))
            start, size = np.flatnonzero(_firsts(key)), size[size > 1]
            group = np.repeat(np.arange(len(size)), size)
            # The members with the least and the largest node: mostly the same ones in all
            # buckets of a group of copies, so the same pairs are proposed again and again.
            crowded = np.repeat(size, size) > CROWDED
            made = []
            for step in range(1, min(CROWDED, int(size.max()))):
                left = np.flatnonzero((key[step:] == key[:-step]) & ~crowded[step:])
                made.append((left, left + step))
            full = np.flatnonzero(crowded)
            last = start + size - 1
            for hub in (start, last):
                made.append((full, hub[group[full]]))
            found = []
            for left, right in made:
                fits = (left != right) & _may_link(n, place, left, right, similarity)
                found.append(np.sort(np.stack([node[left[fits]], node[right[fits]]], axis=1), axis=1))
            pairs = np.unique(np.concatenate(found), axis=0)
            for at in range(0, len(pairs), PAIR_ROWS):
                part = pairs[at : at + PAIR_ROWS]
                none = pa.nulls(len(part), pa.int32())
                both = [pa.array(part[:, 0]), pa.array(part[:, 1]), pa.nulls(len(part), pa.int64())]
                yield pa.record_batch([*both, none, none], ["a", "b", "shingle", "n", "place"])
            if len(full):
                yield pa.record_batch(
                    [
                        pa.array(node[full]), pa.nulls(len(full), pa.int64()), pa.array(key[full]),
                        pa.array(n[full]), pa.array(place[full]),
                    ],
                    ["a", "b", "shingle", "n", "place"],
                )

    dealt = emitted.repartition("shingle").sortWithinPartitions("shingle", "node")
    return dealt.mapInArrow(work, _MET)


def _rest(members: DataFrame, similarity: float, low: int, high: int | None) -> DataFrame:
    """``(a, b)``: the members at places ``low`` to ``high`` of each bucket with all later ones.

    ``members`` has ``shingle, node, n, place, root``. Pairs of one root are linked already and
    left out, as are those that lengths and places rule out.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(found: list[np.ndarray]) -> pa.RecordBatch:
            pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
            return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        names = ["shingle", "node", "n", "place", "root"]
        for key, node, n, place, root in _whole_buckets(batches, names):
            found, held = [], 0
            start = np.flatnonzero(_firsts(key)) if len(key) else []
            for first, end in zip(start, [*start[1:], len(key)], strict=True):
                if (root[first:end] == root[first]).all():
                    continue
                last = end if high is None else min(first + high, end)
                for k in range(first + low, last):
                    other = np.arange(k + 1, end)
                    other = other[root[other] != root[k]]
                    other = node[other[_may_link(n, place, k, other, similarity)]]
                    if len(other):
                        found.append(np.stack([np.full(len(other), node[k]), other], axis=1))
                        held += len(other)
                    if held >= PAIR_ROWS:
                        yield batch(found)
                        found, held = [], 0
            if found:
                yield batch(found)

    dealt = members.repartition("shingle").sortWithinPartitions("shingle", "node")
    return dealt.mapInArrow(work, "a bigint, b bigint").distinct()


def _within_reach(pairs: DataFrame, every: DataFrame, similarity: float) -> DataFrame:
    """The pairs that their bitmaps do not rule out: no pair of the similarity is lost.

    Sets of m and n shingles have the similarity s if and only if at most (1 - s) / (1 + s) of
    m + n stand in one of them only. A bit in which the bitmaps differ has an odd number of those,
    at least one, so more such bits than that rule the pair out. Bitmaps of sizes further
    apart than one halving rule out nothing.
    """
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    known = every.select("node", "n", "bits").join(nodes, "node", "left_semi")
    known = known.dropDuplicates(["node"])
    left = known.toDF("a", "_m", "_mine")
    right = known.toDF("b", "_n", "_theirs")

    def folded(bits, other):
        half = F.floor(F.size(bits) / 2).cast("int")
        halves = F.zip_with(
            F.slice(bits, 1, half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseXOR(y)
        )
        return F.when(F.size(bits) == 2 * F.size(other), halves).otherwise(bits)

    mine, theirs = folded(F.col("_mine"), F.col("_theirs")), folded(F.col("_theirs"), F.col("_mine"))
    differing = F.zip_with(mine, theirs, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    odd = F.aggregate(differing, F.lit(0), lambda total, x: total + x)
    most = F.lit((1 - similarity) / (1 + similarity)) * (F.col("_m") + F.col("_n")) + _SLACK
    ratio = F.least("_m", "_n") >= F.lit(similarity) * F.greatest("_m", "_n") - _SLACK
    joined = pairs.join(left, "a").join(right, "b").filter(ratio)
    return joined.filter(F.coalesce(odd <= most, F.lit(True))).select("a", "b")


def _verified(pairs: DataFrame, every: DataFrame, sets, similarity: float) -> DataFrame:
    """The pairs whose shingles have the similarity, counted on the whole sets; written.

    The bitmaps of ``every`` rule out most of those that do not. ``sets`` gives
    ``(node, shingles)`` of a table of nodes: only those of the pairs left travel.
    """
    spark = pairs.sparkSession
    proposed, proposed_path = written(pairs, "proposed")
    pairs, path = written(_within_reach(proposed, every, similarity), "pairs")
    drop_table(spark, proposed_path)
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    whole, whole_path = written(sets(nodes), "sets")
    few = F.broadcast(pairs) if size_on_disk(spark, path) <= BROADCAST_BYTES else pairs
    left = whole.select(F.col("node").alias("a"), F.col("shingles").alias("mine"))
    right = whole.select(F.col("node").alias("b"), F.col("shingles").alias("theirs"))
    shared = F.size(F.array_intersect("mine", "theirs"))
    joined = left.join(few, "a").join(right, "b").select(
        "a", "b", shared.alias("shared"), (F.size("mine") + F.size("theirs")).alias("both")
    )
    enough = F.col("shared") >= F.lit(similarity) * (F.col("both") - F.col("shared")) - _SLACK
    edges, _ = written(joined.filter(enough).select("a", "b").distinct(), "links")
    drop_table(spark, path)
    drop_table(spark, whole_path)
    return edges


def _small_side(table: DataFrame, label: str) -> DataFrame:
    """``table`` written, and broadcast in a join if it is small."""
    table, path = written(table, label)
    small = size_on_disk(table.sparkSession, path) <= BROADCAST_BYTES
    return F.broadcast(table) if small else table


def similar(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    similarity: float = 0.8,
) -> DataFrame:
    """``(key, node, component)``: groups of texts whose shingles have a Jaccard similarity.

    Groups are exact: two texts are linked if and only if their sets of hashed shingles
    have the similarity. Of two sets that do, the first n - ceil(similarity * n) + 1 shingles
    in any one order share one, so each text emits those, and all texts of a shingle meet.
    A small bucket proposes all pairs. A crowded one proposes those with two members first and
    then, round by round, those of more members with all that the verified links leave apart
    from them, until none is left or all pairs had their turn: a group of copies is linked
    after a few rounds. Every proposed pair is decided on the whole sets, unless bitmaps of them
    show that it falls short. Copies share one node and are reduced to it before that. The
    component is the smallest key in reach; see ``near_duplicates`` for nulls and repeats.
    """
    common = _common(docs, text, shingle)
    every, _ = written(shingle_sets(docs, key, text, shingle, similarity, common), "shingles")
    one = every.groupBy("node").agg(F.min(key).alias("least"), F.count("*").alias("copies"))
    one, _ = written(one, "nodes")
    twice = one.filter("copies > 1").select("node", "least")
    again = every.select("node", key).join(twice, "node").filter(F.col(key) != F.col("least"))
    again = again.select(F.col("node").alias("_node"), F.col(key).alias("_key")).distinct()
    copy = (F.col("node") == F.col("_node")) & (F.col(key) == F.col("_key"))
    firsts = every.join(_small_side(again, "copies"), copy, "left_anti")

    def sets(nodes: DataFrame) -> DataFrame:
        keys = one.join(nodes, "node", "left_semi").select(F.col("least").alias("_key")).distinct()
        chosen = docs.join(
            _small_side(keys, "chosen"), F.col(key).eqNullSafe(F.col("_key")), "left_semi"
        )
        return shingle_sets(chosen, key, text, shingle).select("node", "shingles")

    met, _ = written(_meetings(firsts, similarity), "meetings")
    near = met.filter("b IS NOT NULL").select("a", "b").distinct()
    edges = _verified(near, every, sets, similarity)
    crowded = met.filter("b IS NULL").select("shingle", F.col("a").alias("node"), "n", "place")
    for low, high in HUBS if not crowded.isEmpty() else ():
        reached = components(edges).withColumnRenamed("component", "root")
        members = crowded.join(reached, "node", "left").withColumn("root", F.coalesce("root", "node"))
        members, path = written(members.select("shingle", "node", "n", "place", "root"), "members")
        apart = members.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        apart = apart.filter("low <> high").select("shingle")
        if apart.isEmpty():
            drop_table(docs.sparkSession, path)
            break
        rest = _rest(members.join(apart, "shingle", "left_semi"), similarity, low, high)
        edges = edges.union(_verified(rest, every, sets, similarity))
        drop_table(docs.sparkSession, path)
    return _grouped(every.select(key, "node"), one.select("node", "least"), edges, "node", key)


def keep_one(docs: DataFrame, groups: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of ``groups``: that of the smallest key.

    Of rows that repeat a key one stays. Rows with a null key stay all. The keys that go are
    written first; as long as their table is small the texts are not shuffled.
    """
    spark = docs.sparkSession
    mine = groups.select(F.col(key).alias("_key"), (F.col(key) == F.col("component")).alias("_stays"))
    counted = mine.groupBy("_key").agg(F.min("_stays").alias("_stays"), F.count("*").alias("_n"))
    marked, path = written(counted.filter("not _stays or _n > 1"), "dropped")
    if size_on_disk(spark, path) <= BROADCAST_BYTES:
        marked = F.broadcast(marked)
    same = F.col(key) == F.col("_key")
    others = docs.join(marked, same, "left_anti")
    repeated = marked.filter("_stays")
    if repeated.isEmpty():
        return others
    return others.unionByName(docs.join(repeated, same, "left_semi").dropDuplicates([key]))
