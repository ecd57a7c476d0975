import json
import os
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from quire.operators.predict import first_sentence_predictor
from quire.plans import queries as Q
from quire.plans.evaluate import evaluate, evaluate_rows
from quire.plans.preprocess import preprocess
from quire.plans.training import load_training_data, training_tables, validation_check
from quire.sources import jsonl as J
from quire.sources import tables as T
from quire.streaming.ingest import clean_stream

SF = "/root/testdata/sf0.01"

# The stand-in predictors below run on Python workers, which cannot import
# this test module: ship them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _fixture_file(spark, path):
    rows = sorted(T.defective_lines(Q.pairs(spark, SF)).collect(), key=lambda r: r.idx)
    assert [r.idx for r in rows] == list(range(len(rows)))
    with open(path, "w", encoding="utf-8") as f:
        for r in rows:
            f.write(r.raw + "\n")


def test_preprocess_file_equals_queries(spark, tmp_dir):
    src = f"{tmp_dir}/qa.jsonl"
    _fixture_file(spark, src)
    res = preprocess(spark, src, output_path=f"{tmp_dir}/clean", splits_path=f"{tmp_dir}/splits")
    clean = sorted(tuple(r) for r in res.clean.drop("file").collect())
    assert clean == sorted(tuple(r) for r in Q.v2_clean(spark, SF).collect())
    rep = res.report.first()
    a1 = Q.a1_counts(spark, SF).first()
    assert (rep.total_raw, rep.total_clean, rep.dropped) == tuple(a1)
    assert [r.idx for r in res.first_rejects.collect()] == [r.idx for r in Q.v4_first_rejects(spark, SF).collect()]
    sizes = {r.split: r.n for r in res.split_sizes.collect()}
    assert sum(sizes.values()) == rep.total_clean
    assert J.read_records(spark, f"{tmp_dir}/clean").count() == rep.total_clean
    assert J.read_split(spark, f"{tmp_dir}/splits", "test").count() == sizes["test"]
    assert res.lengths.first().n == rep.total_clean


def _echo_answer():
    def predict(batch):
        return [q[::-1] for q in batch["question"]]
    return predict


def test_evaluate_and_compare(spark, tmp_dir):
    split = Q.D.three_way_split(Q.pairs(spark, SF)).withColumn("domain", F.lit("d"))
    J.write_splits(split, f"{tmp_dir}/splits")
    ev = evaluate(spark, f"{tmp_dir}/splits/split=test", {"base": _echo_answer, "finetuned": first_sentence_predictor},
                  n_samples=100, output_path=f"{tmp_dir}/metrics")
    assert ev.sample.count() == 24
    assert ev.predictions.count() == 48
    cmp = {r.metric: r for r in ev.comparison.collect()}
    assert set(cmp) == {"bleu", "rouge1", "rouge2", "rougeL"}
    files = [p for p in os.listdir(f"{tmp_dir}/metrics") if p.startswith("part-")]
    doc = json.loads(open(f"{tmp_dir}/metrics/{files[0]}").read())
    assert doc["finetuned"]["rouge1"] == cmp["rouge1"].finetuned


def test_training_tables(spark, tmp_dir):
    data = load_training_data(spark, f"{tmp_dir}/missing/qa.jsonl")
    n_train, n_val = data.train.count(), data.val.count()
    assert (n_train, n_val) == (450, 50)
    t = data.train.first().text
    assert "You are a helpful AI assistant." in t and t.endswith("<|eot_id|>")
    check = validation_check(data, first_sentence_predictor)
    assert check.metrics.count() == 1 and check.sample.count() == 50
    td = training_tables(Q.pairs(spark, SF).withColumn("domain", F.lit("d")))
    assert td.val.count() == 24


def test_streaming_ingest(spark, tmp_dir):
    inp, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    os.makedirs(inp)
    _fixture_file(spark, f"{inp}/part1.jsonl")
    q = clean_stream(spark, inp, out, f"{tmp_dir}/ck", available_now=True)
    q.awaitTermination(300)
    got = sorted((r.rid, r.question) for r in spark.read.json(f"{out}/clean").collect())
    want = sorted((r.rid, r.question) for r in Q.v2_clean(spark, SF).collect())
    assert got == want
    rej = spark.read.json(f"{out}/rejects").count()
    assert rej == Q.v3_rejects(spark, SF).count()


def test_preprocess_folder_of_files(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    for name in ("a", "b"):
        with open(f"{tmp_dir}/in/{name}.jsonl", "w") as f:
            for i in range(40):
                f.write(f'{{"question": "question {name} {i}?", "answer": "long enough answer {i}"}}\n')
    res = preprocess(spark, f"{tmp_dir}/in")
    rows = res.splits.collect()
    assert len(rows) == 80 and len({(r.file, r.rid) for r in rows}) == 80
    assert sorted(r.pos for r in rows) == list(range(80))
    again = {(r.file, r.rid): r.pos for r in res.splits.collect()}
    assert again == {(r.file, r.rid): r.pos for r in rows}
    sizes = {s: sum(1 for r in rows if r.split == s) for s in ("train", "val", "test")}
    assert (sizes["train"], sizes["val"], sizes["test"]) == (64, 8, 8)


def test_stream_batch_retry_is_idempotent(spark, tmp_dir):
    from quire.sources.lines import scan_lines
    from quire.streaming.ingest import process_batch

    with open(f"{tmp_dir}/x.jsonl", "w") as f:
        f.write('{"question": "what is it?", "answer": "a long enough answer"}\n\nnot json\n')
    batch = scan_lines(spark, f"{tmp_dir}/x.jsonl")
    out = f"{tmp_dir}/out"
    process_batch(batch, 7, out)
    process_batch(batch, 7, out)  # a retried batch replaces its own output
    assert spark.read.json(f"{out}/clean").count() == 1
    assert spark.read.json(f"{out}/rejects").count() == 1
    rep = spark.read.json(f"{out}/reports").collect()
    assert len(rep) == 1 and rep[0].total_raw == 1 and rep[0].dropped == 1


def test_streaming_two_batches_number_each_file(spark, tmp_dir):
    inp, out, ck = f"{tmp_dir}/in2", f"{tmp_dir}/out2", f"{tmp_dir}/ck2"
    os.makedirs(inp)
    good = '{"question": "what is new here?", "answer": "an answer long enough"}'
    with open(f"{inp}/a.jsonl", "w") as f:
        f.write(good + "\n\nbad\n" + good + "\n")
    clean_stream(spark, inp, out, ck, available_now=True).awaitTermination(300)
    with open(f"{inp}/b.jsonl", "w") as f:
        f.write("\n\n\n" + good + "\n")
    clean_stream(spark, inp, out, ck, available_now=True).awaitTermination(300)
    batches = sorted(p for p in os.listdir(f"{out}/clean") if p.startswith("batch_id="))
    assert batches == ["batch_id=0", "batch_id=1"]
    rows = sorted((os.path.basename(r.file), r.rid) for r in spark.read.json(f"{out}/clean").collect())
    assert rows == [("a.jsonl", 0), ("a.jsonl", 3), ("b.jsonl", 3)]
    rej = [(os.path.basename(r.file), r.idx, r.reason) for r in spark.read.json(f"{out}/rejects").collect()]
    assert rej == [("a.jsonl", 2, "JSON parse error")]
