import math
import random

import numpy as np
import pytest

from orderloom.llm import hard_negatives
from orderloom.llm.hard_negatives import Best, Columns, narrow

SCHEMA = "vec_id long, embedding array<float>, label int, score string, id string, d0 int, place int"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA)


def brute(rows, every, top, share):
    """Every anchor against every row."""
    taken = [
        (k, label, [math.floor(256 * float(np.float32(x))) for x in v]) for k, v, label in rows
        if k is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for key, label, vector in taken:
        if key % every:
            continue
        scored = [(-dot(vector, v), k, la) for k, la, v in taken if k != key]
        liked = sorted(s for s in scored if s[2] == label)[:top]
        for score, positive, _ in liked:
            inside = sorted(s for s in scored if s[2] != label
                            and share[0] * -score <= share[1] * -s[0] <= share[1] * -score)
            out += [(key, positive, rank, n, -score, -s)
                    for rank, (s, n, _) in enumerate(inside[:top], 1)]
    return sorted(out)


def vectors(n, width, seed, spread=1.0):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0, spread) for _ in range(width)], draw.randrange(3)) for i in range(n)]


def found(df, **how):
    return sorted(map(tuple, hard_negatives.hard_negatives(df, **how).collect()))


@pytest.mark.parametrize("block", [3, 1000])
def test_equals_brute_force_in_any_number_of_rounds(spark, block):
    rows = vectors(300, 12, 1)
    df = rows_of(spark, rows).repartition(5)
    got = found(df, anchor_every=25, block=block)
    assert got == brute(rows, 25, 5, (80, 100)) and len(got) > 50


def test_equal_vectors_and_wide_windows(spark):
    # a third of all rows is one vector, so scores tie far beyond the first five
    rows = vectors(120, 6, 2) + [(1000 + i, [0.5] * 6, i % 3) for i in range(80)]
    got = found(rows_of(spark, rows), anchor_every=10, share=(1, 100), positives=4, negatives=4)
    assert got == brute(rows, 10, 4, (1, 100))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(60, 4, 3) + [
        (200, None, 1), (300, [1.0, None], 1), (400, [nan, 1.0], 0), (500, [inf], 2), (600, [], 1),
        (700, [1.0, 0.5], 1), (701, [1.0, 0.5], 1), (702, [0.9, 0.5], 0), (None, [1.0], 1),
        (800, [1.0, 1.0], None), (20, [2.0, 2.0, 0.0, 0.0], 1), (61, [1.0, 0.5], 0),
        (61, [1.0, 0.5], 0), (62, [1.0, 0.5, 0.0], 1), (62, [1.0, 0.5], 1),
    ]
    got = found(rows_of(spark, rows), anchor_every=20)
    assert got == brute(rows, 20, 5, (80, 100))
    assert {700, 20} <= {r[0] for r in got}


def test_nothing_to_find(spark):
    assert found(rows_of(spark, [])) == []
    assert found(rows_of(spark, [(1, [1.0], 1), (2, [1.0], 0)])) == []
    # an anchor without another row of its label has no positives
    assert found(rows_of(spark, [(100, [1.0], 1), (2, [1.0], 0)])) == []
    # nothing is above a score below zero
    assert found(rows_of(spark, [(100, [1.0], 1), (2, [-1.0], 1), (3, [-1.0], 0)])) == []


def test_numbers_too_large_for_exact_sums(spark):
    with pytest.raises(ValueError, match="too large"):
        found(rows_of(spark, [(100, [1e15], 1), (2, [1e15], 1)]))


def test_bounds_leave_few_rows_to_read(spark):
    """Rows far from the window go before their last columns are read."""
    import pyarrow as pa

    draw = np.random.default_rng(5)
    values = draw.integers(-100, 100, (500, 64))
    batch = pa.record_batch(
        [pa.array(range(500)), pa.array([1] * 500), *[pa.array(values[:, d]) for d in range(64)]],
        names=["id", "label", *[f"d{d}" for d in range(64)]],
    )
    block = Columns(batch, 64)
    vector = (1000 * 0.7 ** np.arange(64)).astype(np.int64)
    best, read = Best(-2**62, 2**62, 5), []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            out = np.ndarray.__getitem__(self, at)
            read.append(np.asarray(out).size)
            return np.asarray(out)

    block.values = block.values.view(Watched)
    narrow(block, vector, np.ones(500, dtype=bool), [best])
    expected = sorted(((-s, i) for i, s in enumerate(values @ vector)))[:5]
    assert [(-s, i) for s, i in zip(best.scores, best.ids)] == expected
    assert read[0] == 500 * 8 and sum(read[1:]) < 500 * 8
