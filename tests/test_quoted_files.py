"""Quoted CSV cut into splits, and types from values, against Spark's one-task readers."""

import random

import pytest

from orderloom.sources import files, inference, quoted

SCHEMA = "a string, b string, c int"
SPLIT, OPEN_COST = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in (SPLIT, OPEN_COST)}

    def use(size):
        spark.conf.set(SPLIT, str(size))
        spark.conf.set(OPEN_COST, "1")
    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def one_task(spark, path):
    return spark.read.schema(SCHEMA).options(
        header=True, quote='"', escape='"', multiLine=True).csv(path)


def rows_of(df):
    return sorted(map(str, df.collect()))


def write(path, rows, newline="\n"):
    text = ["a,b,c"]
    for a, b, c in rows:
        field = lambda x: '"' + x.replace('"', '""') + '"'
        text.append(f"{field(a)},{field(b)},{c}")
    path.write_bytes((newline.join(text) + newline).encode())


def made(n, seed):
    draw = random.Random(seed)
    piece = lambda: draw.choice(["x", "wört", '"', '""', ",", "\n", "\n\n", "a,b\nc", " ", "#", ""])
    return [("".join(piece() for _ in range(draw.randrange(6))) or "k",
             "".join(piece() for _ in range(draw.randrange(30))) + "z", i) for i in range(n)]


@pytest.mark.parametrize("size", [37, 200, 4096])
def test_rows_are_those_of_the_multi_line_reader(spark, tmp_path, small_splits, size):
    write(tmp_path / "one.csv", made(300, 1))
    write(tmp_path / "two.csv", made(50, 2))
    expected = rows_of(one_task(spark, str(tmp_path)))
    small_splits(size)
    found = quoted.read(spark, str(tmp_path), one_task(spark, str(tmp_path)).schema)
    assert rows_of(found) == expected and len(expected) == 350
    assert quoted.lines(spark, str(tmp_path)).select("file", "start").distinct().count() > 3
    if size < 4096:
        assert quoted.lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8


def test_a_field_that_spans_many_splits(spark, tmp_path, small_splits):
    rows = [("k", "long\n" * 400 + "end", 1), ("m", "short", 2), ("n", '"\n"' * 200, 3)]
    write(tmp_path / "one.csv", rows)
    small_splits(100)
    found = quoted.read(spark, str(tmp_path), one_task(spark, str(tmp_path)).schema)
    assert sorted(map(tuple, found.collect())) == sorted(rows)


def test_carriage_returns_blank_lines_and_a_missing_last_newline(spark, tmp_path, small_splits):
    (tmp_path / "one.csv").write_bytes(b'a,b,c\r\n"k","v\nw",1\r\n\r\n  \r\nplain,,2\r\n"",x,none')
    expected = rows_of(one_task(spark, str(tmp_path)))
    for size in (11, 10_000):
        small_splits(size)
        found = quoted.read(spark, str(tmp_path), one_task(spark, str(tmp_path)).schema)
        assert rows_of(found) == expected and len(expected) == 4


def test_quotes_that_do_not_pair_are_an_error(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('a,b,c\n"k,v,1\n')
    with pytest.raises(ValueError, match="do not pair in .*bad.csv"):
        quoted.records(spark, str(tmp_path))


def test_only_a_header_and_nothing_at_all(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b,c\n")
    (tmp_path / "two.csv").write_text("")
    schema = one_task(spark, str(tmp_path)).schema
    assert quoted.read(spark, str(tmp_path), schema).count() == 0


# ---- types from values --------------------------------------------------------------------


@pytest.mark.parametrize("texts, kind", [
    ([], "void"), ([None, ""], "void"), (["1", None, "-7", "+3"], "int"),
    (["1", "2147483648"], "bigint"), (["2147483647", "-2147483648"], "int"),
    (["9223372036854775808"], "double"), (["1", "2.5"], "double"), (["1e3", ".5", "2."], "double"),
    (["2020-01-31"], "date"), (["2020-02-31"], "string"),
    (["2020-01-31", "2020-01-31 10:00:00"], "timestamp_ntz"),
    (["2020-01-31T10:00:00.25"], "timestamp_ntz"), (["2020-01-31 25:00:00"], "string"),
    (["true", "FALSE"], "boolean"), (["true", "1"], "string"), (["1", "2020-01-01"], "string"),
    (["1.5", "2020-01-01 00:00:00"], "string"), (["1", " 2"], "string"), (["1", "x"], "string"),
])
def test_types_join(spark, texts, kind):
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    assert inference.column_types({"s": df}).first().data_type == kind


def test_join_does_not_depend_on_order_or_split(spark):
    """The lattice's join is associative, commutative and idempotent on every pair and triple."""
    import functools
    import itertools

    from pyspark.sql import functions as F

    bits = list(inference.BITS.values())
    triples = [(a, b, c, a | b | c) for a, b, c in itertools.product([0, *bits], repeat=3)]
    df = spark.createDataFrame(triples, "a int, b int, c int, j int")
    back = functools.reduce(
        lambda e, kv: e.when(F.col("k") == kv[0], kv[1]),
        [(k, v) for k, v in {**inference.BITS, "void": 0}.items()], F)
    ab = df.withColumn("k", inference.joined_type(F.col("a").bitwiseOR(F.col("b")))).withColumn("ab", back)
    # int and bigint widen to bits that are again joined to the same type
    wrong = ab.select(
        inference.joined_type(F.col("j")).alias("at_once"),
        inference.joined_type(F.col("ab").bitwiseOR(F.col("c"))).alias("in_steps"),
    ).where("at_once <> in_steps")
    assert wrong.count() == 0


def test_an_odd_last_row_widens_its_column(spark, tmp_path):
    path = str(tmp_path / "p.csv")
    spark.range(5000).selectExpr("id", "id * 1.5D AS x", "CAST(NULL AS string) AS nothing").write.options(
        header=True).csv(path)
    assert [f.dataType.simpleString() for f in files.read_csv_inferred(spark, path).schema] == [
        "int", "double", "string"]
    (tmp_path / "p.csv" / "z.csv").write_text("id,x,nothing\n3000000000,n/a,\n")
    found = files.read_csv_inferred(spark, path)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "string", "string"]
    assert found.count() == 5001 and found.where("x = 'n/a'").first().id == 3000000000


def test_every_table_is_scanned_once(spark):
    texts = {n: spark.createDataFrame([("1", "x")], "a string, b string") for n in "pqr"}
    found = inference.column_types(texts)
    assert found.count() == 6
    assert found._jdf.queryExecution().sparkPlan().toString().count("Scan ExistingRDD") == 3
