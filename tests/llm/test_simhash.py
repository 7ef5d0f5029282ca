"""SimHash near-dedup against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from farelens.llm import simhash
from tests.llm import data

SCHEMA = "doc_id BIGINT, text STRING, fp BIGINT, rep STRING, mask INT"


def docs(spark, texts):
    """Extra columns clash with names used inside."""
    return spark.createDataFrame([(i, t, 7, "x", 1) for i, t in texts], SCHEMA)


def brute_fingerprint(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(data.LOWER))
    if not found:
        return 0
    shingles = [" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=2):
    """prints: id -> number. Smallest id reachable, by comparing all pairs."""
    label = {i: i for i in prints}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in prints:
        for j in prints:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= distance:
                one, two = sorted((root(i), root(j)))
                label[two] = one
    return {i: root(i) for i in prints}


def test_near_duplicates_equal_brute_force(spark):
    texts = list(enumerate(data.random_texts(260, 31)))
    rows = simhash.near_duplicates(docs(spark, texts).repartition(3)).collect()
    prints = {i: brute_fingerprint(t) for i, t in texts}
    expected = brute_components(prints)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{prints[i]:016x}", expected[i]) for i, _ in texts}
    assert len(set(expected.values())) < len({p for p in prints.values()}) < len(texts)


@pytest.mark.parametrize("size", [8, 64, 1 << 22])
def test_fingerprint_of_texts_cut_anywhere(monkeypatch, size):
    """Chunks of a text may end inside words, at blanks, and hold fewer words than a shingle."""
    monkeypatch.setattr(simhash, "CHUNK", size)
    for text in [*data.random_texts(60, 32), "a  b\tc d\n\n e f g ", "x" * 100, "ÄÖ éa b", "a b ", " a b"]:
        assert simhash.fingerprint(text) == brute_fingerprint(text), text


def numbers(kind, count, rng):
    if kind == "random":
        out = [rng.getrandbits(64) for _ in range(count)]
    elif kind == "cluster":
        base = rng.getrandbits(64)
        out = [base ^ sum(1 << b for b in rng.sample(range(12), rng.randint(0, 6))) for _ in range(count)]
    else:
        # correlated bits: whole bytes come from few values
        few = [[rng.getrandbits(8) for _ in range(3)] for _ in range(8)]
        out = [sum(rng.choice(few[b]) << 8 * b for b in range(8)) for _ in range(count)]
    for i in range(0, count, 3):
        out[i] = out[i - 1] ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
    return out


@pytest.mark.parametrize("kind,often,block,distance", [
    ("random", 64, 1 << 14, 2), ("cluster", 64, 1 << 14, 2), ("cluster", 2, 16, 2),
    ("correlated", 2, 16, 2), ("cluster", 2, 16, 1)])
def test_links_make_the_same_components(spark, kind, often, block, distance):
    """Also where nearly every value of a part is frequent and lists are split."""
    rng = random.Random(f"{kind}")
    found = {}
    for i, n in enumerate(numbers(kind, 300, rng)):
        found.setdefault(n, i)
    prints = spark.createDataFrame(
        [(int(np.uint64(n).astype(np.int64)), i) for n, i in found.items()], "fp BIGINT, rep BIGINT")
    links = [(r.a, r.b) for r in simhash.links_of(prints, distance, often, block).collect()]
    expected = brute_components({i: n for n, i in found.items()}, distance)
    label = {i: i for i in found.values()}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        one, two = sorted((root(a), root(b)))
        label[two] = one
    assert {i: root(i) for i in label} == expected


def test_rows_of_a_large_group_grow_with_its_size(spark):
    """Near copies of one another all probe the same values: links at most one a member of
    each list, never all pairs."""
    rng = random.Random(5)
    counts = []
    for size in (400, 800):
        base = rng.getrandbits(64)
        found = {base ^ sum(1 << b for b in rng.sample(range(40), rng.randint(0, 4))) for _ in range(size)}
        prints = spark.createDataFrame(
            [(int(np.uint64(n).astype(np.int64)), i) for i, n in enumerate(sorted(found))],
            "fp BIGINT, rep BIGINT")
        counts.append(simhash.links_of(prints, 2, often=8).count() / len(found))
    assert counts[1] < 1.5 * counts[0] + 1


def test_allocation_is_the_cheapest_and_complete():
    rng = np.random.default_rng(3)
    cost = rng.random((50, 3, 4))
    cost[:, :, 0] = 0
    units = simhash.allocate(cost)
    assert (units.sum(axis=1) == 3).all()
    for row, own in zip(cost, units):
        every = [(a, b, 3 - a - b) for a in range(4) for b in range(4 - a)]
        least = min(sum(row[p, u] for p, u in enumerate(deal)) for deal in every)
        assert sum(row[p, u] for p, u in enumerate(own)) == pytest.approx(least)


def test_correlated_bits_stand_together():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    source = hashes & np.uint64(1)
    for bit in (9, 30, 50, 63):
        hashes = hashes & ~(np.uint64(1) << np.uint64(bit)) | source << np.uint64(bit)
    bits = simhash.bits_of(hashes).astype(float)
    groups = simhash.bit_groups(bits.T @ bits, len(hashes), 3)
    assert sorted(sum(groups, [])) == list(range(64)) and {len(g) for g in groups} == {21, 22}
    assert {0, 9, 30, 50, 63} <= set(groups[0])


def test_nulls_repeats_and_nothing(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "A b c d e"), (3, None), (4, ""), (5, " \n"),
            (None, "q r s"), (None, "a b c d e"), (6, "u v w x"), (6, "k l m n"), (7, "k l m n")]
    got = [(r.doc_id, r.fingerprint, r.component_id)
           for r in simhash.near_duplicates(docs(spark, rows)).collect()]
    assert len(got) == len(rows)
    zero = "0" * 16
    assert sorted((g for g in got if g[0] in (3, 4, 5))) == [(i, zero, 3) for i in (3, 4, 5)]
    assert {g[2] for g in got if g[0] in (1, 2)} == {1}
    assert {g[2] for g in got if g[0] in (6, 7)} == {6}
    assert sorted(str(g[2]) for g in got if g[0] is None) == ["1", "None"]


def test_a_very_long_text(spark):
    rng = random.Random(8)
    long = " ".join(f"w{rng.randrange(50_000)}" for _ in range(400_000))
    rows = simhash.near_duplicates(docs(spark, [(1, long), (2, long + " end"), (3, "short one here")])).collect()
    found = {r.doc_id: r for r in rows}
    assert found[1].fingerprint == f"{brute_fingerprint(long):016x}"
    assert found[2].component_id == 1 and found[3].component_id == 3
