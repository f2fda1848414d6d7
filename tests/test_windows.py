import random

from pyspark.sql import functions as F

from recordloom.operators import spread, windows


def test_ranges_over_blocks(spark):
    r = random.Random(1)
    data = [(g, n) for g in ("a", "b") for n in range(-50, 400) if r.random() < 0.9] + [("a", 7)]
    want = set()
    for g in ("a", "b"):
        numbers = sorted({n for h, n in data if h == g})
        start = numbers[0]
        for n, after in zip(numbers, [*numbers[1:], 10**9]):
            if after != n + 1:
                want.add((g, start, n, n - start + 1))
                start = after
    rows = spark.createDataFrame(data, "g string, n long")
    for block in (1, 2, 10, 100_000):
        assert {tuple(x) for x in windows.ranges(rows, ["g"], "n", block).select("g", "first", "last", "n").collect()} == want


def test_numbered(spark):
    data = [(None if k % 3 == 0 else k % 3, k * 7919 % 1000) for k in range(1000)]
    rows = spark.createDataFrame(data, "g int, v int")
    got = spread.numbered(rows, ["g"], [F.desc("v")], "at").collect()
    for g in (None, 1, 2):
        mine = sorted((x for x in got if x.g == g), key=lambda x: -x.v)
        assert [x["at"] for x in mine] == list(range(len(mine))) and {x.at_of for x in mine} == {len(mine)}
    assert spread.numbered(rows.limit(0), ["g"], [F.col("v")], "at").collect() == []


def test_apart(spark):
    left = spark.createDataFrame([(k % 5, k) for k in range(50)], "a long, x int")
    right = spark.createDataFrame([(k, f"r{k}") for k in range(3)], "a long, y string")
    assert sorted(map(tuple, spread.apart(left, right, ["a"]).collect())) == sorted(map(tuple, left.join(right, "a").collect()))


def test_shared_folder_needs_a_name_on_a_cluster():
    from recordloom.operators import durable

    assert durable.single_machine("local[4]") and durable.single_machine("local") and not durable.single_machine("local-cluster[2,1,1024]") and not durable.single_machine("spark://x:7077")


def test_kept_rows_are_deleted_when_told(spark):
    from recordloom.operators import durable

    since = durable.mark(spark)
    a, b = durable.keep(spark.range(5)), durable.keep(spark.range(7))
    durable.drop(a)
    assert b.count() == 7 and durable.mark(spark) == since + 1
    durable.drop_since(spark, since)
    assert durable.mark(spark) == since
    import pytest

    with pytest.raises(Exception):
        b.count()


def test_small_inputs_are_dealt_out(spark, sf):
    from recordloom.operators.spread import dealt

    rows = spark.read.parquet(f"{sf}/documents.parquet")
    assert dealt(rows).count() == rows.count() and "REPARTITION" in dealt(rows)._jdf.queryExecution().executedPlan().toString()
