import random

import numpy as np
import xxhash

from corpusloom.llm import graph, simhash
from corpusloom.llm.queries import op7_simhash
from tests.llm.conftest import LONG, ROWS


def plain_fingerprint(text, size=3):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    runs = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    runs = runs or [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {n: find(n) for n in nodes}


def test_fingerprints_equal_the_plain_definition(odd):
    got = simhash.fingerprints(odd).collect()
    want = sorted((str(k), plain_fingerprint(t)) for k, t, *_ in ROWS if t != LONG)
    found = sorted((str(r.doc_id), r.fingerprint % 2**64) for r in got if r.doc_id != 5)
    assert found == want


def test_majority_over_many_hashes():
    rng = np.random.default_rng(1)
    runs = np.array([0, 1, 2, 255, 256, 1000, 0, 7])
    hashes = rng.integers(0, 2**63, runs.sum(), dtype=np.uint64)
    got = simhash.majority_bits(hashes, runs)
    at = 0
    for n, bits in zip(runs, got, strict=True):
        own = hashes[at : at + n]
        at += n
        want = sum(1 << b for b in range(64) if 2 * int(((own >> np.uint64(b)) & np.uint64(1)).sum()) > n)
        assert int(bits) == want


def test_links_connect_exactly_what_is_within_three_bits(spark):
    rng = random.Random(5)
    values = {0, 1, 2**63, 2**64 - 1}
    for _ in range(12):
        center = rng.getrandbits(64)
        for _ in range(14):
            value = center
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                value ^= 1 << bit
            values.add(value)
        block = 16 * rng.randrange(4)  # three bits of one block
        values.add(center ^ (1 << block) ^ (1 << block + 5) ^ (1 << block + 15))
    values = sorted(values)
    rows = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    edges = simhash.links(spark.createDataFrame(rows, "fingerprint bigint"))
    pairs = {(r.a % 2**64, r.b % 2**64) for r in edges.collect()}
    assert all(0 < (a ^ b).bit_count() <= 3 for a, b in pairs)
    assert plain_components(values, lambda a, b: (a ^ b).bit_count() <= 3) == plain_components(
        values, lambda a, b: (a, b) in pairs or (b, a) in pairs
    )


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, k) for k in range(300, 340)]
    edges += [(5, 5), (139, 7), (None, 3), (600, 601), (601, 600), (600, 601)]
    rng.shuffle(edges)
    nodes = sorted({n for e in edges for n in e if n is not None and e[0] != e[1] and None not in e})
    got = graph.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    want = plain_components(nodes, lambda a, b: (a, b) in edges or (b, a) in edges)
    assert {r.node: r.component for r in got.collect()} == want
    assert got.count() == len(nodes)
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_query_equals_brute_force(spark, sf):
    rows = op7_simhash(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    prints = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    assert {r.doc_id: int(r.fingerprint, 16) for r in rows} == prints and len(rows) == len(docs)
    groups = plain_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert {r.doc_id: r.component_id for r in rows} == groups


def test_near_duplicates_of_odd_rows(odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ROWS)
    component = {r.doc_id: r.component for r in rows}
    assert component[2] == component[3] == component[4] == 2
    assert component[6] == component[7] == 6 and component[8] == 8
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_similar_finds_near_copies_and_leaves_others(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    rows, base = [], []
    for k in range(40):
        text = [rng.choice(words) for _ in range(rng.randint(60, 300))]
        base.append(text)
        rows.append((k, " ".join(text)))
        for j in range(1, 4):  # each changed word spoils five shingles
            copy = list(text)
            for at in rng.sample(range(len(copy)), max(1, len(copy) // 90)):
                copy[at] = "changed"
            rows.append((100 * j + k, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    component = {r.doc_id: r.component for r in simhash.similar(docs).collect()}
    found = sum(component[100 * j + k] == k for j in range(1, 4) for k in range(40))
    assert found >= 0.95 * 120
    assert len({component[k] for k in range(40)}) == 40


def test_keep_one_keeps_odd_rows(documents):
    groups = simhash.similar(documents.filter("doc_id IS NOT NULL"))
    kept = simhash.keep_one(documents, groups)
    assert kept.columns == documents.columns
    # 2, 3 and 4 have no words; 6 and 7 are copies; 8 is repeated; the row without key stays.
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "5", "6", "8", "9", "None"]
    empty = documents.limit(0)
    assert simhash.keep_one(empty, simhash.similar(empty)).count() == 0


def plain_shingles(text, size=5):
    words = text.lower().split()
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def similar_groups(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id: r.component for r in simhash.similar(docs).collect()}


def exact_groups(texts):
    sets = [plain_shingles(t) for t in texts]
    return plain_components(range(len(sets)), lambda a, b: jaccard(sets[a], sets[b]) >= 0.8)


def test_similar_finds_copies_with_a_passage_added_cut_or_replaced(spark):
    rng = random.Random(9)
    texts = []

    def fresh(n):
        return [f"v{rng.randrange(10**9)}" for _ in range(n)]

    for n in (104, 404):
        for share in (0.8, 0.85, 0.9, 0.95):
            for _ in range(5):
                text = fresh(n)
                more = int((n - 4) / share) - (n - 4)
                cut = n - int((n - 4) * (1 - share))
                swap = max(1, int((n - 4) * (1 - share) / (1 + share)) - 4)
                texts += [text, text + fresh(more)]
                other = fresh(n)
                texts += [other, other[:cut]]
                third = fresh(n)
                texts += [third, third[:40] + fresh(swap) + third[40 + swap :]]
    texts = [" ".join(t) for t in texts]
    sets = [plain_shingles(t) for t in texts]
    assert min(jaccard(sets[k], sets[k + 1]) for k in range(0, len(sets), 2)) >= 0.8
    got = similar_groups(spark, texts)
    assert all(got[k] == got[k + 1] == k for k in range(0, len(texts), 2))


def test_similar_verifies_every_pair_of_a_crowded_bucket(spark, monkeypatch):
    rng = random.Random(4)
    shared = [f"s{i}" for i in range(180)]
    texts = [shared + [f"o{rng.randrange(10**9)}" for _ in range(60)] for _ in range(150)]
    for k in range(0, 150, 5):  # a true pair in the middle of the family
        texts.append([*texts[k][:-3], "changed", *texts[k][-2:]])
    texts = [" ".join(t) for t in texts]
    want = exact_groups(texts)
    assert len(set(want.values())) == 150
    # Without the order by frequency all of the family meet in the passage's buckets.
    monkeypatch.setattr(simhash, "ORDER_SHINGLES", 0)
    assert similar_groups(spark, texts) == want


def test_similar_links_nothing_below_the_similarity(spark):
    rng = random.Random(6)
    texts = []
    for k in range(40):
        text = [f"u{k}x{i}" for i in range(124)]
        swap = rng.randint(2, 24)
        texts += [text, text[:50] + [f"z{k}x{i}" for i in range(swap)] + text[50 + swap :]]
    texts = [" ".join(t) for t in texts]
    want = exact_groups(texts)
    assert 40 < len(set(want.values())) < 80
    assert similar_groups(spark, texts) == want


def test_bitmaps_rule_out_no_pair_of_the_similarity(spark):
    rng = random.Random(12)
    texts = []
    for n in (30, 70, 140, 290, 600):
        for similarity in (0.3, 0.5, 0.8, 0.9):
            text = [f"w{rng.randrange(10**9)}" for _ in range(n)]
            longer = text + [f"w{rng.randrange(10**9)}" for _ in range(int((n - 4) / similarity) - n + 4)]
            texts += [text, longer]
    texts = [" ".join(t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    every = simhash.shingle_sets(docs, "doc_id", "text").cache()
    node = {r.doc_id: r.node for r in every.collect()}
    sets = {node[k]: plain_shingles(t) for k, t in enumerate(texts)}
    nodes = sorted(sets)
    pairs = [(a, b) for a in nodes for b in nodes if a < b]
    proposed = spark.createDataFrame(pairs, "a bigint, b bigint")
    for similarity in (0.3, 0.8):
        kept = simhash._within_reach(proposed, every, similarity).collect()
        kept = {tuple(r) for r in kept}
        true = {(a, b) for a, b in pairs if jaccard(sets[a], sets[b]) >= similarity}
        assert true and true <= kept
    # At 0.8 next to nothing but those is left.
    assert len(kept) <= len(true) + 3
    every.unpersist()
