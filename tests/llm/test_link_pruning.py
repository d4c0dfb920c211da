import random

import numpy as np
from pyspark.sql import functions as F

from orderloom.llm import components as parts, ngram_join


def plain_roots(edges, size):
    root = list(range(size))
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(root[a], root[b])
            for node in (a, b):
                if root[node] != least:
                    root[node], changed = least, True
    return root


def test_roots_equal_plain_propagation():
    rng = random.Random(5)
    for size in (1, 2, 30, 400):
        edges = [(rng.randrange(size), rng.randrange(size)) for _ in range(size)]
        u, v = (np.array([e[i] for e in edges]) for i in (0, 1))
        assert parts.roots_of(u, v, size).tolist() == plain_roots(edges, size)
    line = np.arange(999)
    assert not parts.roots_of(line + 1, line, 1000).any()


def test_components_of_a_long_chain_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(parts, "CHUNK", 16)
    links = spark.range(0, 300).selectExpr("concat('n', id + 1000) AS a", "concat('n', id + 1001) AS b")
    found = parts.components(links.repartition(7))
    assert found.count() == 301
    assert [r[0] for r in found.select("component").distinct().collect()] == ["n1000"]


def test_pairs_that_may_be_similar_are_reachable(spark):
    """Every pair that meets as often as it must passes, whatever lists the two are in besides."""
    rng = random.Random(7)
    rows, n, m = [], 40, 3
    prefix = n - ngram_join.least_overlap(n, 80) + m
    for doc in range(60):
        rows += [(doc, t) for t in rng.sample(range(-40, 40), prefix)]
    live = spark.createDataFrame(rows, "_id long, _token long")
    facts = ngram_join._memberships(live).withColumns({"_n": F.lit(n), "_m": F.lit(m)})
    ours = facts.select(*[F.col(c).alias(f"_a{c}") for c in facts.columns])
    theirs = facts.select(*[F.col(c).alias(f"_b{c}") for c in facts.columns])
    passed = {
        (r[0], r[1]) for r in ours.join(theirs, F.col("_a_id") < F.col("_b_id"))
        .where(ngram_join._reachable("_a", "_b", 80)).select("_a_id", "_b_id").collect()
    }
    lists = {}
    for doc, token in rows:
        lists.setdefault(doc, set()).add(token)
    # the shared shingles that sets of this size need, less what lies behind the prefixes
    needed = max(m, -(-2 * n * 80 // 180) - (n - prefix))
    expected = {
        (a, b) for a in lists for b in lists if a < b and len(lists[a] & lists[b]) >= needed
    }
    assert expected <= passed
    assert len(passed) < 60 * 59 // 2


def test_a_pair_is_made_in_the_first_list_that_both_name(spark):
    """No pair that shares lists is lost; one that both documents name is the only one it is made in."""
    rng = random.Random(11)
    n, m = 12, 1
    rows = [(doc, t) for doc in range(40) for t in rng.sample(range(60), rng.choice((3, 12)))]
    live = spark.createDataFrame(rows, "_id long, _token long")
    facts = ngram_join._memberships(live).withColumns(
        {"_n": F.lit(n), "_m": F.lit(m), **{b: F.lit(0).cast("long") for b in ngram_join.BITS}}
    )
    group = F.col("_id") % 9
    some = live.join(facts, "_id").withColumns({"_group": group, "_largest": F.pmod("_token", F.lit(9))})
    made = [tuple(sorted(r)) for r in ngram_join._meetings(some, 80).select("_a", "_b").collect()]
    lists = {}
    for doc, token in rows:
        lists.setdefault(doc, set()).add(token)
    first = {d: set(sorted(t)[: ngram_join.NAMED]) for d, t in lists.items()}
    # all sets are of one size here, so similar ones share this many lists at least
    least = max(m, -(-2 * n * 80 // 180) - (ngram_join.least_overlap(n, 80) - m))
    for a in lists:
        for b in lists:
            if a >= b or a % 9 == b % 9 or len(lists[a] & lists[b]) < least:
                continue
            assert made.count((a, b)) == (1 if first[a] & first[b] else len(lists[a] & lists[b]))


def test_pairs_share_as_many_lists_as_their_prefixes_ask_for(spark):
    lists = spark.createDataFrame(
        [(1, 10, 2, [1, 2, 3, 4, 5]), (2, 10, 3, [2, 3, 4, 5, 6]), (3, 10, 2, [4, 5, 6, 7, 8])],
        "_id long, _n long, _m int, _in array<long>",
    )
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long")
    # sets of 10 share 8 at least, of which no more than 4 lie behind a prefix
    assert [tuple(r) for r in ngram_join._matching(pairs, lists, 60).collect()] == [(1, 2)]
