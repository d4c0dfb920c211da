import random
from itertools import combinations

from pyspark.sql import functions as F

from orderloom.llm import decontaminate, line_templates, ngram_join, revisits
from orderloom.llm.components import components

from odd_rows import ROWS, empty, odd  # noqa: F401


def brute_groups(rows, words=5, percent=80):
    def shingles(text):
        spelled = [w.lower() for w in (text or "").split()]
        if not spelled:
            return frozenset()
        size = min(words, len(spelled))
        return frozenset(tuple(spelled[i:i + size]) for i in range(len(spelled) - size + 1))

    sets = {k: shingles(t) for k, t in rows}
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in combinations(sorted(sets), 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if both and 100 * both >= percent * either:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {k: (len(s), root(k)) for k, s in sets.items()}


def near_copies():
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [draw.choice(vocabulary) for _ in range(60)]
    rows = []
    for group in range(12):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([3, 5, 30, 120]))]
        if group % 3 == 0:
            base = base + passage
        for _ in range(draw.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 4])):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    return rows + [(len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, "A b"), (len(rows) + 3, "a B")]


def test_similar_groups_match_brute_force(spark, monkeypatch):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_groups(docs).collect()}
    assert found == brute_groups(rows)
    # the same without any pivot
    monkeypatch.setattr(ngram_join, "ROUNDS", 0)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_groups(docs).collect()}
    assert found == brute_groups(rows)


def test_similar_groups_of_odd_rows(odd, empty):
    rows = ngram_join.similar_groups(odd).collect()
    assert len(rows) == len(ROWS)
    got = {r.doc_id: r.component_id for r in rows}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8, None: None}
    assert ngram_join.similar_groups(empty).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (5, 4), (20, 20), *[(100, n) for n in range(101, 140)]]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{n: 1 for n in (1, 2, 3, 4, 5)}, **{n: 10 for n in (10, 11, 12)}, **{n: 100 for n in range(100, 140)}}


#: Texts that suffice, from so many tokens on, of which so many in a hundred are constants.
LEVELS = ((10, 1, 60), (5, 8, 80), (3, 20, 90), (2, 50, 90))


def brute_lines(rows):
    """The template tree on one machine, from the words of its rule."""
    from collections import defaultdict
    digit = lambda token: any(c in "0123456789" for c in token)
    lines = [
        (key, text or "", at, [t for t in line.split(" ") if t])
        for key, text in rows for at, line in enumerate((text or "").split("\n")) if line.strip()
    ]
    leaf = lambda tokens: (len(tokens), *["<*>" if digit(t) else t for t in tokens[:3]])
    spots, templates, firsts = (defaultdict(set) for _ in range(3))
    for key, text, at, tokens in lines:
        for place, token in enumerate(tokens):
            if not digit(token):
                spots[leaf(tokens), place, token].add(text)
    named = []
    for key, text, at, tokens in lines:
        own = []
        for least, from_, percent in LEVELS:
            held = tuple((p, t) for p, t in enumerate(tokens)
                         if not digit(t) and len(spots[leaf(tokens), p, t]) >= least)
            if held and len(tokens) >= from_ and len(held) * 100 >= len(tokens) * percent:
                own.append((least, leaf(tokens), held))
        if any(map(digit, tokens)):
            own.append((min(least for least, from_, _ in LEVELS if len(tokens) >= from_), tuple(tokens)))
        for name in own:
            named.append((key, at, name))
            templates[name].add(text)
            firsts[name].add((key, at))
    return {(k, at) for k, at, n in named if len(templates[n]) >= n[0] and (k, at) != min(firsts[n])}


def test_recurring_lines_match_brute_force(spark):
    rows = []
    for i in range(40):
        own = [chr(97 + i % 26) * (2 + i // 26) + suffix for suffix in "abcdefgh"]
        lines = ["a line of " + " ".join(own)]
        if i % 2 == 0:
            lines.insert(0, f"Visited {i} times since 19{i:02d} by our dear readers")
        if i % 3 == 0:
            lines.append("All rights reserved.")
        rows.append((i, "\n".join(lines)))
    rows += [(100 + i, "copied line of text that many have") for i in range(20)]  # one text, many copies
    rows += [(200, None), (201, ""), (202, "\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    drop = brute_lines(rows)
    assert len(drop) == 19 + 13
    found = line_templates.without_recurring_lines(docs).collect()
    for r, (key, text) in zip(sorted(found, key=lambda r: r.doc_id), rows):
        lines = (text or "").split("\n")
        kept = [line for at, line in enumerate(lines) if (key, at) not in drop]
        assert (r.doc_id, r.n_lines, r.n_dropped) == (key, len(lines), len(lines) - len(kept))
        assert r.text == (text if len(kept) == len(lines) else "\n".join(kept))


def test_short_lines_recur_and_blank_lines_stay(spark):
    rows = [(i, f"Les.\r\n\r\n\t\nown{chr(97 + i)}\n\u3000\nAnd ornd.\n\n7") for i in range(12)]
    found = line_templates.without_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.n_dropped, r.text) for r in found.where("doc_id > 0").collect()}
    assert {k: t.split("\n")[:4] for k, (_, t) in got.items()} == {
        i: ["\r", "\t", f"own{chr(97 + i)}", "\u3000"] for i in range(1, 12)}
    assert {t.count("Les.") + t.count("And ornd.") for _, t in got.values()} == {0}
    assert found.where("doc_id = 0").first().text == rows[0][1]


def test_long_lines_need_fewer_texts(spark):
    own = lambda i, n: " ".join(f"{chr(97 + i)}{chr(97 + j // 20)}{chr(97 + j % 20)}" for j in range(n))
    passage = {n: own(20, n) for n in (7, 12, 30, 60)}
    held = {7: 9, 12: 5, 30: 3, 60: 2}  # so many texts have the passage
    rows = [(i, "\n".join([own(i, 25), *[p for n, p in passage.items() if i < held[n]]])) for i in range(9)]
    edited = passage[60].split()
    edited[40] = "else"
    rows.append((9, own(9, 25) + "\n" + " ".join(edited)))  # equal but for a word
    rows.append((10, own(10, 25) + "\n" + own(21, 12)))
    rows.append((11, own(11, 25) + "\n" + own(21, 12)))  # twelve words in two texts stay
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_templates.without_recurring_lines(docs).collect()}
    expected = {i: own(i, 25) + "\n" + passage[7] for i in range(1, 9)}
    expected |= {0: rows[0][1], 9: own(9, 25), 10: rows[10][1], 11: rows[11][1]}
    assert got == expected


def test_equal_lines_recur_whatever_their_digits(spark):
    same = "Page 12 of 40\n2024-01-05 12:33:01 INFO started"
    rows = [(i, f"{same}\n{i} 7 {i}\n{'0123456789ab'[i]}x") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_templates.without_recurring_lines(docs).collect()}
    assert got == {i: t if i == 0 else t.removeprefix(same + "\n") for i, t in rows}


def test_lines_of_odd_rows(odd, empty):
    found = line_templates.without_recurring_lines(odd)
    assert found.count() == len(ROWS) and found.columns == [*odd.columns, "n_lines", "n_dropped"]
    assert found.agg(F.sum("n_dropped")).first()[0] == 0
    assert line_templates.without_recurring_lines(empty).count() == 0


def edit_distance_within(item, text):
    before = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (a != b)))
        before = now
    return min(before)


def test_bit_parallel_distance():
    draw = random.Random(3)
    for _ in range(500):
        item = "".join(draw.choice("abc") for _ in range(draw.randint(1, 12)))
        text = "".join(draw.choice("abc") for _ in range(draw.randint(0, 25)))
        assert decontaminate.least_distance(
            decontaminate.letter_masks(item), len(item), text) == edit_distance_within(item, text)


def test_hits_match_brute_force(spark):
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(draw.randint(6, 14)))) for i in range(6)]
    items += [(90, "too short"), (91, None), (92, items[0][1].upper() + "!")]
    docs = []
    for i in range(40):
        letters = list(items[i % 6][1]) if i % 2 else []
        for _ in range(draw.randint(0, 6) if letters else 0):
            letters[draw.randrange(len(letters))] = draw.choice("xyz ")
        docs.append((i, " ".join([*(word() for _ in range(8)), "".join(letters), word()])))
    docs += [(100, None), (101, ""), (102, "x Too, short. y"), (103, "xtoo short"), (104, "too shorty")]
    plain = {i: decontaminate.normalised(t or "") for i, t in items}
    expected = {}
    for key, text in docs:
        text = decontaminate.normalised(text or "")
        hits = {
            i: edit_distance_within(p, text) for i, p in plain.items()
            if p and (len(p) >= 20 or f" {p} " in f" {text} ")
        }
        expected[key] = {i: d for i, d in hits.items() if d <= int(len(plain[i]) * 0.05)}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    listed = spark.createDataFrame(items, "item_id long, text string")
    for block in (decontaminate.BLOCK, 100):  # in one block, and in several
        found = decontaminate.with_hits(frame, listed, block=block).collect()
        got = {r.doc_id: {h.item_id: h.distance for h in r.hits} for r in found}
        assert got == expected
    assert any(expected.values()) and not all(expected.values())


def test_short_items_are_whole_words():
    finder = decontaminate.Finder([(1, "is it so"), (2, "東京はどこ"), (3, "x")], 0.05)
    assert finder.hits("Is it so?") == finder.hits("so is it so, yes") == {1: 0}
    assert finder.hits("this it so") == finder.hits("is it sold") == finder.hits("isitso") == {}
    assert finder.hits("質問東京はどこですか") == {2: 0}
    assert finder.hits("xx a x") == {3: 0} and finder.hits("xx") == {}


def test_hits_of_odd_rows(odd, empty, spark):
    listed = spark.createDataFrame([(1, "quick brown fox jumps over")], "item_id long, text string")
    found = decontaminate.with_hits(odd, listed)
    assert {r.doc_id for r in found.where("size(hits) > 0").collect()} == {1, 2}
    assert found.count() == len(ROWS)
    assert decontaminate.with_hits(empty, listed).count() == 0
    assert decontaminate.with_hits(odd, listed.limit(0)).where("size(hits) > 0").count() == 0


def test_canonical_addresses(spark):
    same = ["http://www.A.org/x/?b=2&utm_source=y&a=1#top", "https://a.org:443/x?a=1&b=2", "a.org/x/?a=1&ref=q&b=2"]
    rows = spark.createDataFrame([(u,) for u in same], "url string")
    assert {r[0] for r in rows.select(revisits.canonical(F.col("url"))).collect()} == {"a.org/x?a=1&b=2"}


def brute_revisits(rows):
    found = {}
    for r in rows:
        if r[3] != 304:
            continue
        earlier = [q for q in rows if q[3] == 200 and q[1] and q[1] == r[1] and q[2] is not None
                   and r[2] is not None and (q[2], q[0]) < (r[2], r[0])]
        found[r[0]] = max(earlier, key=lambda q: (q[2], q[0]))[0] if earlier else None
    return found


def test_revisits_match_brute_force(spark):
    draw = random.Random(4)
    rows = []
    for i in range(600):
        url = draw.choice(["hot.org/a"] * 4 + ["b.org", "c.org/x", "d.org", None])
        status = draw.choice([200, 304, 304, 404])
        at = draw.choice([None, *range(50)])
        headers = {"etag": f'"{draw.randint(0, 3)}"', "content-type": "text/html" if status == 200 else "none",
                   "date": str(at)}
        rows.append((i, url, at, status, headers if draw.random() < 0.9 else None, f"d{i % 4}"))
    schema = "record_id long, url string, at long, status int, headers map<string,string>, digest string"
    found = {r.record_id: r for r in revisits.resolve(spark.createDataFrame(rows, schema)).collect()}
    expected = brute_revisits(rows)
    assert {k: r.target_id for k, r in found.items()} == expected
    by_id = {r[0]: r for r in rows}
    for key, r in found.items():
        own = by_id[key][4] or {}
        if r.target_id is None:
            assert r.verdict == "no response" and r.headers == own and not r.resolved
            continue
        target = by_id[r.target_id]
        if own:
            same = (target[4] or {}).get("etag") == own["etag"]
            assert r.verdict == ("etag" if same else "changed")
        else:
            assert r.verdict == ("digest" if by_id[key][5] == target[5] else "changed")
        if r.resolved:
            merged = {**(target[4] or {}), **{k: v for k, v in own.items() if k != "content-type"}}
            assert r.headers == merged and r.digest == target[5]
    assert revisits.resolve(spark.createDataFrame([], schema)).count() == 0
