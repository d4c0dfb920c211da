import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from orderloom.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label string, code int, error int, q int"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(k, [math.floor(scale * x) for x in v], label) for k, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(-(-max((len(v) for _, v, _ in kept), default=0) // parts), 1)
    cut = lambda v: [(v + [0] * (parts * width - len(v)))[p * width: (p + 1) * width] for p in range(parts)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))[:entries]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(parts)]

    def assign(v):
        return [min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))
                for x, book in zip(cut(v), books)]

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v, _ in kept:
            for p, (_, j) in enumerate(assign(v)):
                members[p, j].append(cut(v)[p])
        for (p, j), own in members.items():
            books[p][j] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = [(k, label, assign(v)) for k, v, label in kept]
    total = defaultdict(int)
    for _, label, a in coded:
        total[label] += sum(d for d, _ in a)
    return sorted((str(k), "".join(f"{j:02x}" for _, j in a), sum(d for d, _ in a), total[label], digest)
                  for k, label, a in coded)


def found(df, **how):
    rows = vector_codes.compressed(df, **how).collect()
    return sorted((str(r.id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in rows)


def vectors(n, width, seed):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0, 0.1) for _ in range(width)], draw.choice(["a", "b", None]))
            for i in range(n)]


@pytest.mark.parametrize("width", [1, 2, 3, 8, 12, 16])
def test_transform_keeps_distances_and_orders_by_sign_changes(width):
    draw = np.random.default_rng(width)
    a, b = draw.integers(-1000, 1000, (2, 7, width))
    size = vector_codes.padded_width(width)
    assert ((vector_codes.walsh(a) - vector_codes.walsh(b)) ** 2).sum(1).tolist() == (
        size * ((a - b) ** 2).sum(1)).tolist()
    rows = vector_codes.walsh(np.eye(size, dtype=np.int64)).T
    assert [int((np.diff(r) != 0).sum()) for r in rows] == list(range(size))


def test_nearest_is_exact_and_ties_go_to_the_smaller_index():
    draw = np.random.default_rng(3)
    vectors_, entries = draw.integers(-3, 4, (400, 5)), draw.integers(-3, 4, (9, 5))
    entries[6] = entries[2]
    code, squared = vector_codes.nearest(vector_codes.walsh(vectors_), vector_codes.walsh(entries))
    every = ((vectors_[:, None] - entries[None]) ** 2).sum(2)
    assert code.tolist() == every.argmin(1).tolist() and squared.tolist() == every.min(1).tolist()


@pytest.mark.parametrize("width", [64, 20])
def test_equals_brute_force(spark, width):
    rows = vectors(150, width, width)
    assert found(rows_of(spark, rows).repartition(4)) == brute(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(20, 9, 4) + [
        (50, None, "a"), (51, [1.0, None], "a"), (52, [nan], "b"), (53, [inf], "b"), (54, [], "a"),
        (None, [0.1, 0.2], None), (55, [0.3], "c"), (2, [0.1] * 9, "a"), (2, [0.1] * 9, "a"),
    ] + [(100 + i, [0.25] * 9, "hot") for i in range(40)]
    assert found(rows_of(spark, rows)) == brute(rows)


def test_fewer_rows_than_entries(spark):
    rows = vectors(5, 16, 6)
    got = found(rows_of(spark, rows))
    assert got == brute(rows) and all(r[2] == 0 for r in got)


def test_nothing_to_code(spark):
    assert found(rows_of(spark, [])) == []
    assert found(rows_of(spark, [(1, None, "a")])) == []
    assert [r[1:3] for r in found(rows_of(spark, [(1, [], "a")]))] == [("00" * 8, 0)]


def test_numbers_too_large_for_exact_sums(spark):
    with pytest.raises(ValueError, match="too large"):
        found(rows_of(spark, [(1, [1e12] * 8, "a")]))
