"""What the line templates compute of every line, and what the row filters look up."""

import re

from pyspark.sql import functions as F

from orderloom.llm import line_templates, shared


def test_lines_are_sized_and_led_as_their_tokens_say(spark):
    texts = ["a b c d", "  a  b 7c   d ", " ", "\t", " x y", " ", "3 b", "one", "x\ty z", "", "é 1"]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "_id long, _text string, _text_hash long")
    lead = F.array_join(F.transform(F.slice("_t", 1, 3), lambda t: F.when(t.rlike("[0-9]"), "<*>").otherwise(t)), "|")
    tokens = spark.createDataFrame(
        [(i, [t for t in text.split(" ") if t]) for i, text in enumerate(texts) if text.strip()],
        "_id long, _t array<string>",
    )
    expected = tokens.select("_id", F.size("_t"), F.xxhash64(F.size("_t"), F.split(lead, r"\|"))).collect()
    found = line_templates._lines(docs, 3, 1).select("_id", "_size", "_leaf").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, expected))


def test_no_null_filter_sizes_the_lines_again(spark):
    levels = ((10, 1, 60), *line_templates.FIRMER)
    docs = spark.createDataFrame([(1, "a b", 1)], "_id long, _text string, _text_hash long")
    lines = line_templates._lines(docs, 3, 1).withColumn("_fewest", line_templates._fewest(F.col("_size"), levels))
    common = line_templates._common(lines, ["_leaf", "_fewest"], F.col("_fewest"))
    plan = common._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Filter .*(octet_length|split\(|array_min)", plan)


def test_filter_finds_its_keys_at_every_bit(spark):
    keys = spark.range(0, 4000, 2)
    kept = shared.row_filter(keys, F.col("id"), 2**16)
    marked = shared.with_pass(spark.range(4000), kept, F.col("id"), "go", 2**16)
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(2**16))
    held = {r[0] for r in keys.select(place("id")).collect()}
    rows = marked.select("id", "go", place("id").alias("at")).collect()
    assert {r.at % 64 for r in rows} == set(range(64))
    assert all(r.go == (r.at in held) for r in rows) and not all(r.go for r in rows)
