import hashlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators import split as D
from quire.operators.position import dense_index
from quire.plans import queries as Q
from tests_support import plan_text

import pyref


def ids(spark, n):
    return spark.range(n).select((F.col("id") * 7 + 3).alias("rid"))


@pytest.mark.parametrize("n,sizes", [(10, (8, 1, 1)), (9, (7, 0, 2)), (1, (0, 0, 1)), (0, (0, 0, 0)), (233, (186, 23, 24))])
def test_split_sizes_golden(spark, n, sizes):
    assert pyref.expected_sizes(n) == sizes
    got = {r.split: r.n for r in D.split_sizes(ids(spark, n)).collect()}
    assert (got["train"], got["val"], got["test"]) == sizes
    rows = D.three_way_split(ids(spark, n), buckets=4).collect()
    counts = {s: sum(1 for r in rows if r.split == s) for s in ("train", "val", "test")}
    assert (counts["train"], counts["val"], counts["test"]) == sizes


def test_positions_equal_global_row_number(spark):
    df = ids(spark, 1000)
    ours = {r.rid: r.pos for r in D.shuffle_positions(df, buckets=7).collect()}
    key = F.md5(F.concat(F.col("rid").cast("string"), F.lit(":42")))
    ref = df.withColumn("pos", F.row_number().over(Window.orderBy(key, "rid")) - 1)
    assert ours == {r.rid: r.pos for r in ref.collect()}


def test_positions_match_python_md5_order(spark):
    n = 300
    rids = [i * 7 + 3 for i in range(n)]
    order = sorted(rids, key=lambda r: (hashlib.md5(f"{r}:42".encode()).hexdigest(), r))
    got = {r.rid: r.pos for r in D.shuffle_positions(ids(spark, n), buckets=5).collect()}
    assert [r for r, _ in sorted(got.items(), key=lambda kv: kv[1])] == order


def test_split_is_stable_under_repartition(spark):
    a = {r.rid: (r.pos, r.split) for r in D.three_way_split(ids(spark, 500), buckets=3).collect()}
    b = {r.rid: (r.pos, r.split) for r in D.three_way_split(ids(spark, 500).repartition(11), buckets=9).collect()}
    assert a == b


def test_train_val_split(spark):
    rows = D.train_val_split(ids(spark, 233)).collect()
    n_val = sum(1 for r in rows if r.split == "val")
    assert n_val == pyref.expected_val_size(233) == 24
    assert sorted(r.pos for r in rows) == list(range(233))
    first = {r.rid for r in D.three_way_split(ids(spark, 233)).collect() if r.pos < 24}
    assert first != {r.rid for r in rows if r.split == "val"}  # a second, independent order


def test_head_sample(spark):
    split = D.three_way_split(ids(spark, 50))
    head = D.head_sample(split, 5).collect()
    assert [r.pos for r in head] == [0, 1, 2, 3, 4]
    assert len(D.head_sample(split, 500).collect()) == 50


def test_no_single_partition_row_shuffle(spark):
    plan = plan_text(Q.d2_split(spark, "/root/testdata/sf0.001"))
    # The ranking window is partitioned by bucket; only the per-bucket
    # offsets table (one row per bucket) is ordered in one partition.
    assert "hashpartitioning(_bucket" in plan
    assert "BroadcastHashJoin" in plan


def test_dense_index(spark):
    df = spark.range(0, 3000, 3).select((F.col("id") * 13 % 3001 - 500).alias("k"))
    for bits in (0, 4, 20):
        got = dense_index(df, "k", bits=bits)
        assert "heckpoint" not in plan_text(got)
        ks = sorted(r.k for r in got.collect())
        assert sorted((r.idx, r.k) for r in got.collect()) == list(enumerate(ks))


def test_null_ids_are_an_error(spark):
    df = spark.createDataFrame([(1,), (None,)], "rid long")
    with pytest.raises(Exception, match="null in the id column rid"):
        D.shuffle_positions(df).collect()


def test_partitions_are_even(spark):
    """Buckets hashed to 200 partitions: the largest is under 1.5 times the mean."""
    n = 200
    buckets = spark.range(n * D.BUCKETS_PER_PARTITION).select(F.col("id").alias("b")).repartition(n, "b")
    sizes = [r[0] for r in buckets.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == n and max(sizes) < 1.5 * D.BUCKETS_PER_PARTITION


def test_texts_are_not_in_the_ranking(spark):
    df = spark.range(50).select(F.col("id").alias("rid"), F.lit("text").alias("text"))
    plan = plan_text(D.shuffle_positions(df))
    assert all("text" not in line for line in plan.split("\n") if "hashpartitioning(_bucket" in line)
    assert sorted(r.pos for r in D.shuffle_positions(df).collect()) == list(range(50))


def test_head_is_a_filter(spark):
    test = D.three_way_split(ids(spark, 500)).where("split = 'test'")
    plan = plan_text(D.head_sample(test, 20))
    assert "TakeOrdered" not in plan
    assert sorted(r.pos for r in D.head_sample(test, 20).collect()) == list(range(450, 470))
    loose = spark.createDataFrame([(3,), (9,), (5,)], "pos long")
    assert sorted(r.pos for r in D.head_sample(loose, 2, dense=False).collect()) == [3, 5]


def test_f3_index_is_row_number(spark):
    from quire.sources import tables as T

    lines = T.defective_lines(Q.pairs(spark, "/root/testdata/sf0.01"))
    got = sorted(r.idx for r in lines.collect())
    assert got == list(range(233))


@pytest.mark.parametrize("split", ["train", "val", "test"])
@pytest.mark.parametrize("n", [0, 3, 10**6])
def test_head_of_a_split_ranks_once(spark, split, n):
    df = spark.range(137).select(F.col("id").alias("rid"), F.lit("x").alias("question"))
    rows = D.three_way_split(df).where(F.col("split") == split).orderBy("pos").limit(n).drop("split").collect()
    head = D.split_head(df, split, n)
    assert sorted(map(tuple, head.collect())) == sorted(map(tuple, rows)) and head.columns == ["rid", "question", "pos"]
    numbered = df.withColumnRenamed("rid", "idx")
    dense = D.three_way_split(numbered, index_col="idx").where(F.col("split") == split).orderBy("pos").limit(n).select("pos").collect()
    assert sorted(r.pos for r in D.split_head(numbered, split, n, index_col="idx").collect()) == [r.pos for r in dense]
    plan = D.split_head(df.select("rid"), split, n)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number") == 1
    with pytest.raises(ValueError):
        D.split_head(df, "other")
