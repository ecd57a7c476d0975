"""The keyed permutation, numbers of stored rows, and splits by them."""

import pytest
from pyspark.sql import functions as F

import pyref
from quire.operators import split as D
from quire.operators.permute import bases, permuted
from quire.operators.position import stored_index
from tests_support import plan_text

SIZES = [1, 2, 3, 4, 5, 7, 10, 16, 17, 37, 100, 101, 257, 1000, 4097, 50_001]


@pytest.mark.parametrize("n", SIZES)
def test_a_permutation(spark, n):
    a, b = bases(n)
    assert a * b >= n and a * b - n < a
    df = spark.range(n).select(permuted(F.col("id"), n, 42).alias("p"))
    assert sorted(r.p for r in df.collect()) == list(range(n))


def test_seeds_and_salts_differ_and_reruns_agree(spark):
    def order(*key):
        return [r.p for r in spark.range(500).select(permuted(F.col("id"), 500, *key).alias("p")).orderBy("p").collect()], \
               [r.p for r in spark.range(500).select("id", permuted(F.col("id"), 500, *key).alias("p")).orderBy("id").collect()]

    one, two, salted = order(42)[1], order(43)[1], order(42, "x")[1]
    assert one == order(42)[1]
    for other in (two, salted):
        assert sum(x == y for x, y in zip(one, other)) < 10


def test_places_are_uniform(spark):
    """Over 400 seeds, every row of 20 comes to every place about as often, and neighbours do not stay together."""
    n, seeds = 20, 400
    orders = []
    for start in range(0, seeds, 20):
        part = spark.range(n).select("id", *[permuted(F.col("id"), n, s).alias(f"s{s}") for s in range(start, start + 20)]).orderBy("id").collect()
        orders += [[r[f"s{s}"] for r in part] for s in range(start, start + 20)]
    chi = sum((sum(o[i] == p for o in orders) - seeds / n) ** 2 / (seeds / n) for i in range(n) for p in range(n))
    assert 270 < chi < 460          # 361 degrees of freedom: 361 +- 27 each standard deviation
    together = sum(abs(o[i] - o[i + 1]) == 1 for o in orders for i in range(n - 1)) / (seeds * (n - 1))
    assert abs(together - 2 / n) < 0.02


def test_a_row_outside_is_an_error(spark):
    for bad in ("-1", "10", "cast(null as bigint)"):
        with pytest.raises(Exception, match="index not in"):
            spark.range(1).select(permuted(F.expr(bad), 10, 42)).collect()


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 997])
def test_splits_are_exact(spark, n):
    df = spark.range(n).select(F.col("id").alias("idx"), F.concat(F.lit("q"), "id").alias("question"))
    rows = D.three_way_split(df, index_col="idx").collect()
    want = pyref.expected_sizes(n)
    assert [sum(r.split == s for r in rows) for s in ("train", "val", "test")] == list(want)
    assert sorted(r.pos for r in rows) == list(range(n)) and all(r.question == f"q{r.idx}" for r in rows)
    two = D.train_val_split(df, index_col="idx").collect()
    assert sum(r.split == "val" for r in two) == pyref.expected_val_size(n)


def test_no_exchange_of_records(spark, tmp_dir):
    spark.range(0, 3000, 1, 7).select(F.col("id").alias("rid"), F.lit("q").alias("question")).write.parquet(f"{tmp_dir}/t")
    numbered = stored_index(spark, f"{tmp_dir}/t")
    split = D.three_way_split(numbered, index_col="idx", n=3000)
    plan = plan_text(split)
    assert "Python" not in plan and plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(_file")
    assert plan.count("Window [") == plan.count("Window [sum(_n")       # one row a file
    rows = split.orderBy("idx").collect()
    assert [r.idx for r in rows] == list(range(3000)) and [r.rid for r in rows] == list(range(3000))


def test_numbers_do_not_depend_on_how_files_are_cut(spark, tmp_dir):
    spark.range(0, 20_000, 1, 5).select("id", F.sha2(F.col("id").cast("string"), 512).alias("x")).write.option("parquet.block.size", "65536").parquet(f"{tmp_dir}/t")
    before, got = spark.conf.get("spark.sql.files.maxPartitionBytes"), []
    for size in ("20000", "10000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got.append({(r.id, r.idx) for r in stored_index(spark, f"{tmp_dir}/t").select("id", "idx").collect()})
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got[0] == got[1] and {i for _, i in got[0]} == set(range(20_000))
