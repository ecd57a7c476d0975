"""Sources and sinks through files that are cut into several blocks."""

import os

from pyspark.sql import functions as F

from quire.plans import file_queries as FQ
from quire.session import checkpoint_dir
from quire.sources import jsonl as J
from quire.sources.lines import content_lines, number_written, scan_lines

ODD = ["", " ", "\n", "a\n\n b \n", "\tlead and trail　", "é x\x0by", "x" * 5000, "one"]


def _local(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_lines_keep_their_numbers_over_many_blocks(spark):
    texts = [(i, ODD[i % len(ODD)] + f" {i}" if i % 3 else None) for i in range(300)]
    df = spark.createDataFrame(texts, "rid bigint, text string").repartition(7)
    seen = {}

    def read(path):
        scanned = scan_lines(spark, path)
        seen["parts"] = scanned.rdd.getNumPartitions()
        return scanned

    with_small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = FQ.through_files(spark, "t", lambda p: FQ.write_text_files(df, p, 100), lambda p: (spark.conf.set(
        "spark.sql.files.maxPartitionBytes", "4096"), read(p))[1])
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == with_small
    assert seen["parts"] > 10 and rows.select("file").distinct().count() == 3
    got = sorted((int(r.file.split("file_no=")[1].split("/")[0]), r.idx, r.line) for r in content_lines(number_written(rows)).collect())
    want = []
    for k in range(3):
        raw = "\n".join((t or "") for i, t in texts if i // 100 == k).split("\n")
        want += [(k, n, line.strip()) for n, line in enumerate(raw) if line.strip()]
    assert got == sorted(want)


def test_records_come_back_with_null_domains_and_every_character(spark):
    rows = [(i, f"question {t}", f"answer \\ \" {t}", None if i % 2 else "d") for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "rid bigint, question string, answer string, domain string")
    back = FQ.through_files(spark, "t", lambda p: J.write_records(df, p), lambda p: J.read_records(spark, p))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)


def test_files_are_deleted_and_the_table_kept(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("value"))
    made = {}

    def write(path):
        made["path"] = path
        df.write.text(path)

    back = FQ.through_files(spark, "t", write, lambda p: spark.read.text(p))
    assert not os.path.exists(_local(made["path"])) and back.count() == 10
    assert _local(back.inputFiles()[0]).startswith(_local(checkpoint_dir(spark)))


def test_no_rows(spark):
    none = spark.createDataFrame([], "rid bigint, text string")
    rows = FQ.through_files(spark, "t", lambda p: FQ.write_text_files(none, p), lambda p: scan_lines(spark, p))
    assert content_lines(number_written(rows)).collect() == []
