"""Vector codes against Lloyd with full scans in Python integers."""

import math
import random
from hashlib import sha256

import numpy as np
import pytest

from farelens.llm import vector_codes

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, codes STRING, kind INT"


def table(spark, rows):
    """Extra columns clash with names used inside."""
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def random_rows(count, seed, dims=16):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(count):
        kind = rng.random()
        if kind < 0.2 and rows:
            vector = list(rng.choice(rows)[1])
        elif kind < 0.4:
            # few values, so that distances tie
            vector = [float(rng.randint(-1, 1)) / 8 for _ in range(dims)]
        else:
            vector = [c + rng.gauss(0, 0.3) for c in rng.choice(centres)]
        rows.append((i, [float(np.float32(x)) for x in vector], rng.choice([None, 0, 1, 2])))
    return rows


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows
            if v is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    first = sorted(kept)[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def codes():
        return [[min(range(len(books[p])), key=lambda e: (far(cut(v, p), books[p][e]), e))
                 for p in range(parts)] for _, v, _ in kept]

    for _ in range(rounds):
        found = codes()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), c in zip(kept, found) if c[p] == e]
                if own:
                    books[p][e] = [sum(col) // len(own) for col in zip(*own)]
    found = codes()
    errors = [sum(far(cut(v, p), books[p][c[p]]) for p in range(parts)) for (_, v, _), c in zip(kept, found)]
    by_label = {}
    for (_, _, label), error in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + error
    digest = sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted((i, "".join(f"{x:02x}" for x in c), error, by_label[label], digest)
                  for (i, _, label), c, error in zip(kept, found, errors))


@pytest.mark.parametrize("count", [400, 9, 1])
def test_equals_full_scans(spark, count):
    rows = random_rows(count, count)
    rows += [(1000, None, 1), (1001, [1.0, None] * 8, 1), (1002, [float("nan")] * 16, 1),
             (1003, [float("inf")] * 16, None), (1004, [], 0)]
    random.Random(1).shuffle(rows)
    got = vector_codes.code_report(table(spark, rows).repartition(3)).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == brute(rows)


def test_active_entries_give_what_a_full_scan_gives():
    rng = np.random.default_rng(6)
    part = rng.integers(-4, 5, (500, 3))
    books = [rng.integers(-4, 5, (16, 3))]
    for _ in range(5):
        after = books[-1].copy()
        changed = rng.choice(16, rng.integers(0, 7), replace=False)
        after[changed] = rng.integers(-4, 5, (len(changed), 3))
        books.append(after)
    code, far = vector_codes.nearest(part, books[0])
    for before, after in zip(books, books[1:]):
        code, far = vector_codes.nearest_again(part, after, (before != after).any(axis=1), code, far)
        wanted = vector_codes.nearest(part, after)
        assert np.array_equal(code, wanted[0]) and np.array_equal(far, wanted[1])


def test_parts_that_stay_look_at_moved_entries_only(monkeypatch):
    part = np.arange(12).reshape(6, 2)
    entries = np.array([[0, 1], [10, 11], [50, 50], [90, 90]])
    code, far = vector_codes.nearest(part, entries)
    seen = []
    plain = vector_codes.squares
    monkeypatch.setattr(vector_codes, "squares", lambda p, e: seen.append((len(p), len(e))) or plain(p, e))
    moved = np.array([False, True, False, False])
    entries[1] = [9, 10]
    vector_codes.nearest_again(part, entries, moved, code, far)
    assert seen == [(int((code == 1).sum()), 4), (int((code == 0).sum()), 1)]


def test_odd_rows_have_a_defined_result(spark):
    assert vector_codes.code_report(table(spark, [])).collect() == []
    assert vector_codes.code_report(table(spark, [(1, None, 0)])).collect() == []
    rows = [(1, [0.5] * 10, 0), (2, [0.25] * 10, 0), (2, [0.25] * 10, 0), (3, [1.0] * 3, 0), (None, [1e30] * 10, None)]
    got = {(r.vec_id, r.code, r.error) for r in vector_codes.code_report(table(spark, rows)).collect()}
    assert len(got) == 4 and (3, None, None) in got
    assert all(len(code) == 16 for i, code, _ in got if i != 3)
    only = vector_codes.code_report(table(spark, [(None, [0.5] * 8, 0)])).collect()
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in only] == [(None, "00" * 8, 0, 0)]


def test_codes_stand_for_near_vectors(spark):
    rows = random_rows(300, 7)
    codes, books = vector_codes.compress(table(spark, rows))
    errors = {r.vec_id: r.error for r in codes.collect()}
    for row in vector_codes.decoded(codes, books, 16).collect():
        whole = dict((i, v) for i, v, _ in rows)[row.vec_id]
        apart = sum((math.floor(4096 * a) - 4096 * b) ** 2 for a, b in zip(whole, row.embedding))
        assert round(apart) == errors[row.vec_id]
