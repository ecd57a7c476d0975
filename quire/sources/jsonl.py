"""Typed JSONL load and the JSONL/JSON sinks.

Sinks write folders of part files (one per task), never one file through one
task; the order of rows lives in the data (``rid``, ``pos``), not in file
order.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quire.operators.metrics import METRICS
from quire.sources.lines import read_jsonl_lines

# ``file`` is there when rows came from files; (file, rid) is then a row's identity.
CLEAN_SCHEMA = StructType([
    StructField("file", StringType()),
    StructField("rid", LongType()),
    StructField("question", StringType()),
    StructField("answer", StringType()),
    StructField("domain", StringType()),
])
SPLIT_SCHEMA = StructType(CLEAN_SCHEMA.fields + [StructField("pos", LongType())])
CLEAN_FIELDS = ["rid", "question", "answer", "domain"]

# Null fields are written as null (``"domain": null``), as json.dumps does;
# dropping them would turn a null domain into "general" on the next read.
WRITE_OPTIONS = {"ignoreNullFields": "false", "encoding": "UTF-8"}


def read_records(spark: SparkSession, path: str, schema: StructType = CLEAN_SCHEMA) -> DataFrame:
    """S3: a JSONL file or folder with a declared schema (no inference pass).

    ``FAILFAST``: a malformed line in our own output is an error, not a NULL
    row.  Records without an id (``question``, ``answer``, ``domain`` only)
    get their file and line number, and as ``pos``, where the schema has one,
    their place in the order of files and lines.  ``file`` is left out where
    all records come with an id of their own and none with a file.
    """
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    known = rows.agg(F.count(F.lit(1)).alias("n"), F.count("rid").alias("ids"), F.count("file").alias("files")).first()
    if known["ids"] == known["n"]:
        return rows if known["files"] else rows.drop("file")
    lines = read_jsonl_lines(spark, path).withColumnRenamed("file", "_path")
    value = F.from_json("line", schema, {"mode": "FAILFAST"})
    rows = lines.select("_path", "idx", value.alias("_v")).select("_path", "idx", "_v.*")
    if "pos" in schema.names:
        counts = lines.groupBy("_path").agg((F.max("idx") + 1).alias("_n"))
        before = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
        offsets = counts.select(F.col("_path").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
        rows = rows.join(offsets, F.col("_path") == F.col("_p")).withColumn("pos", F.coalesce("pos", F.col("_offset") + F.col("idx")))
    own = F.col("rid").isNotNull()
    return rows.withColumns({"file": F.when(own, F.col("file")).otherwise(F.col("_path")), "rid": F.coalesce("rid", "idx")}).select(*schema.names)


def read_split(spark: SparkSession, splits_path: str, split: str | None = None) -> DataFrame:
    """S3 over the S7 layout; ``split`` filters by folder (partition pruning)."""
    schema = StructType(SPLIT_SCHEMA.fields + [StructField("split", StringType())])
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(splits_path)
    if df.where(F.col("file").isNotNull()).limit(1).count() == 0:
        df = df.drop("file")
    return df.where(F.col("split") == split) if split else df


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` matches a file or folder (checked through Spark's own reader)."""
    try:
        spark.read.format("text").load(path).schema  # noqa: B018 - listing only, no job
        return True
    except AnalysisException as e:
        if (e.getCondition() or "") == "PATH_NOT_FOUND":
            return False
        raise


def load_or_sample(spark: SparkSession, path: str, n: int = 500, seed: int = 42) -> DataFrame:
    """The records at ``path``; when there is nothing there, the S4 sample is written there first."""
    from quire.sources.sample import sample_qa

    if not path_exists(spark, path):
        write_records(sample_qa(spark, n, seed), path)
    return read_records(spark, path)


def _source(df: DataFrame) -> list[str]:
    return ["file"] if "file" in df.columns else []


def write_records(clean: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Clean rows as JSONL, fields in the order rid, question, answer, domain (``file`` first when present)."""
    clean.select(*_source(clean), *CLEAN_FIELDS).write.mode(mode).options(**WRITE_OPTIONS).json(path)


def write_splits(split_rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per split (``split=train`` ...), ``pos`` kept so stored order can be rebuilt."""
    split_rows.select(*_source(split_rows), *CLEAN_FIELDS, "pos", "split").write.mode(mode).partitionBy("split") \
        .options(**WRITE_OPTIONS).json(path)


def metrics_json(table: DataFrame) -> DataFrame:
    """S8 body: one row, one column ``json`` = {label: {bleu, rouge1, rouge2, rougeL}}."""
    entry = F.struct(F.col("label"), F.struct(*[F.col(m) for m in METRICS]))
    return table.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("json"))


def write_metrics(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The metric table as one JSON document (one row per label, so one small file)."""
    metrics_json(table).coalesce(1).write.mode(mode).text(path)
