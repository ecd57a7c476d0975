"""Hot keys: one domain / one conversation / one id range holding most rows."""

from collections import Counter

from pyspark.sql import functions as F

from quire.operators import profile as P
from quire.operators import split as D
from quire.operators import validate as V
from quire.operators.metrics import pair_predictions
from quire.sources.tables import qa_pairs
from tests_support import lines_df, plan_text


def test_hot_domain_report(spark):
    lines = []
    for i in range(3000):
        dom = "hot" if i % 10 else f"d{i % 7}"
        lines.append(f'{{"question": "question {i}?", "answer": "an answer of enough length {i}", "domain": "{dom}"}}')
    flat = V.validate_lines(lines_df(spark, lines))
    rep = P.ingest_report(flat).first()
    hist = {r.domain: r.n for r in P.report_domains(flat).collect()}
    assert rep.total_clean == 3000 and rep.n_domains == len(hist)
    expect = Counter("hot" if i % 10 else f"d{i % 7}" for i in range(3000))
    assert hist == dict(expect)
    plan = plan_text(P.ingest_report(flat))
    assert "partial_count" in plan or "partial_sum" in plan


def test_hot_conversation_pairs(spark):
    rows = [(0, t, "user" if t % 2 == 0 else "assistant", f"text {t}") for t in range(4000)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"c{c} t{t}") for c in range(1, 200) for t in range(4)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pairs = qa_pairs(conv)
    assert pairs.count() == 2000 + 199 * 2
    plan = plan_text(pairs)
    # Dealt by (conv_id, turn), not by conv_id alone.
    keys = [x for x in plan.split("\n") if "hashpartitioning(conv_id" in x]
    assert all("turn" in x for x in keys)
    joins = [x for x in plan.split("\n") if x.startswith(("Left keys", "Right keys"))]
    assert joins and all("conv_id" in x and "turn" in x for x in joins)


def test_clustered_ids_spread_evenly(spark):
    # ids packed in one narrow range: hashing still spreads them over buckets
    ids = spark.range(20000).select((F.col("id") + 10**12).alias("rid"))
    pos = D.shuffle_positions(ids, buckets=16)
    assert sorted(r.pos for r in pos.select("pos").collect()) == list(range(20000))
    key = D.order_key("rid")
    buckets = ids.select(F.shiftright(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(16), 32).alias("b"))
    sizes = [r["count"] for r in buckets.groupBy("b").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * (20000 / 16)


def test_pairing_keeps_partition_count(spark):
    preds = spark.range(100).select(F.lit("m").alias("label"), F.col("id").alias("rid"), F.lit("x").alias("prediction"))
    refs = spark.range(100).select(F.col("id").alias("rid"), F.lit("y").alias("answer"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paired = pair_predictions(preds, refs)
    assert paired.rdd.getNumPartitions() == n  # tiny rows, still not coalesced into one task
    assert "REPARTITION_BY_NUM" in plan_text(paired)
