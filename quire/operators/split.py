"""Seeded shuffle, exact splits and head samples.

The shuffle is a total order on ``md5(rid ':' seed)`` (ties by ``rid``), so it
is the same on every run, partitioning and engine.  ``pos`` is the 0-based
rank in that order, computed without a single-partition sort:

1. ``bucket`` = the top 32 bits of the key, scaled to ``buckets`` ranges.  The
   key is a hash, so buckets are equal in size whatever the ids look like
   (no skew, no sampling), and bucket order agrees with key order.
2. rank inside a bucket: ``row_number`` over a window partitioned by bucket;
3. bucket offset: running sum of per-bucket counts.  That table has one row
   per bucket (a bound we choose), so it is broadcast.

Everything is a pure function of the data, so re-running a lost task or
evaluating the plan twice gives the same ``pos``; no cache is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.permute import permuted

# The reference's defaults.
DEFAULT_SEED = 42
TRAIN_RATIO = 0.8
VAL_RATIO = 0.1
TEST_SIZE = 0.1
EVAL_SAMPLES = 100
TRAIN_EVAL_SAMPLES = 50
TRAIN_VAL_SALT = "train_test_split"
# So many buckets a partition that hashing them to partitions leaves no straggler.
BUCKETS_PER_PARTITION = 64


def _ids(id_col: str | list[str]) -> list[str]:
    return [id_col] if isinstance(id_col, str) else list(id_col)


def order_key(id_col: str | list[str] = "rid", seed: int = DEFAULT_SEED, salt: str | None = None) -> Column:
    """``md5(id ':' seed)``; with several id columns ``md5(id1 ':' id2 ... ':' seed)``.

    A null id is an error: all such rows would share one key.
    """
    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.raise_error(F.lit(f"null in the id column {c}")).cast("string"))

    parts = [known(c) for c in _ids(id_col)] + [F.lit(str(seed))] + ([F.lit(salt)] if salt else [])
    return F.md5(F.concat_ws(":", *parts))


def _default_buckets(df: DataFrame) -> int:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(1, BUCKETS_PER_PARTITION * parts)


def shuffle_positions(df: DataFrame, id_col: str | list[str] = "rid", seed: int = DEFAULT_SEED,
                      salt: str | None = None, buckets: int | None = None) -> DataFrame:
    """Adds ``pos`` (0-based rank in seeded order) and ``n`` (row count).

    ``id_col`` (one column or several) must identify rows uniquely.  ``buckets`` sets how many window partitions the
    ranking uses (default: 64 times ``spark.sql.shuffle.partitions``).  The ids
    alone are ranked; other columns are joined to their positions by id.
    """
    ids = _ids(id_col)
    ranked = _positions(df.select(*ids), ids, seed, salt, buckets)
    return ranked if set(df.columns) == set(ids) else df.join(ranked, ids)


def _positions(df: DataFrame, id_col: list[str], seed: int, salt: str | None, buckets: int | None) -> DataFrame:
    """The id columns plus ``pos`` and ``n``."""
    b = int(buckets or _default_buckets(df))
    if b < 1 or b >= 2**31:
        raise ValueError("buckets must be in [1, 2^31)")
    keyed = df.withColumn("_key", order_key(id_col, seed, salt)).withColumn(
        "_bucket", F.shiftright(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * F.lit(b), 32))
    by_bucket = Window.partitionBy("_bucket").orderBy("_key", *_ids(id_col))
    ranked = keyed.withColumn("_rank", F.row_number().over(by_bucket) - 1)
    # One row per bucket: at most `b` rows, a bound fixed here, so broadcast it.
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_c"))
               .withColumn("_offset", F.coalesce(F.sum("_c").over(running), F.lit(0)))
               .withColumn("n", F.sum("_c").over(Window.partitionBy()))
               .select("_bucket", "_offset", "n"))
    return (ranked.join(F.broadcast(offsets), "_bucket")
            .withColumn("pos", (F.col("_offset") + F.col("_rank")).cast("long"))
            .drop("_key", "_bucket", "_rank", "_offset"))


def dense_positions(df: DataFrame, index_col: str, n: int | None = None, seed: int = DEFAULT_SEED, salt: str | None = None) -> DataFrame:
    """D1 for rows numbered 0..n-1 (:func:`quire.operators.position.stored_index`, S1's line numbers): adds ``pos`` and ``n``.

    ``pos`` is a keyed permutation of the numbers, a function of each row
    alone: no sort, window or shuffle, and the record stays where it is.  A number that is null
    or not in 0..n-1 is an error.  ``n`` is counted where it is not given.
    """
    n = df.count() if n is None else n
    return df.withColumn("pos", permuted(F.col(index_col), n, seed, salt or "")).withColumn("n", F.lit(n).cast("long"))


def _ordered(df: DataFrame, id_col: str | list[str], seed: int, salt: str | None, buckets: int | None, index_col: str | None, n: int | None) -> DataFrame:
    return dense_positions(df, index_col, n, seed, salt) if index_col else shuffle_positions(df, id_col, seed, salt=salt, buckets=buckets)


def cut_points(n: Column, train_ratio: float = TRAIN_RATIO, val_ratio: float = VAL_RATIO) -> tuple[Column, Column]:
    """``int(n*train_ratio)`` and ``int(n*val_ratio)`` in IEEE double arithmetic."""
    n_train = F.floor(n.cast("double") * F.lit(float(train_ratio))).cast("long")
    n_val = F.floor(n.cast("double") * F.lit(float(val_ratio))).cast("long")
    return n_train, n_val


def three_way_split(df: DataFrame, id_col: str | list[str] = "rid", train_ratio: float = TRAIN_RATIO,
                    val_ratio: float = VAL_RATIO, seed: int = DEFAULT_SEED, buckets: int | None = None,
                    index_col: str | None = None, n: int | None = None) -> DataFrame:
    """Exact train/val/test split: the first ``int(n*0.8)`` positions, the next ``int(n*0.1)``, the rest.

    With ``index_col``, the order of :func:`dense_positions`, else that of :func:`shuffle_positions`.
    """
    pos = _ordered(df, id_col, seed, None, buckets, index_col, n)
    n_train, n_val = cut_points(F.col("n"), train_ratio, val_ratio)
    split = (F.when(F.col("pos") < n_train, F.lit("train"))
             .when(F.col("pos") < n_train + n_val, F.lit("val"))
             .otherwise(F.lit("test")))
    return pos.withColumn("split", split).drop("n")


def split_sizes(df: DataFrame, train_ratio: float = TRAIN_RATIO, val_ratio: float = VAL_RATIO) -> DataFrame:
    """D3: rows per split, zero-sized splits included.

    The sizes are a function of the row count alone, so this is one count and
    no regrouping of the split rows.
    """
    n = F.col("n")
    n_train, n_val = cut_points(n, train_ratio, val_ratio)
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.inline(F.array(
        F.struct(F.lit("train").alias("split"), n_train.alias("n")),
        F.struct(F.lit("val").alias("split"), n_val.alias("n")),
        F.struct(F.lit("test").alias("split"), (n - n_train - n_val).alias("n")),
    )))


def train_val_split(df: DataFrame, id_col: str | list[str] = "rid", test_size: float = TEST_SIZE, seed: int = DEFAULT_SEED,
                    buckets: int | None = None, index_col: str | None = None, n: int | None = None) -> DataFrame:
    """Two-way split with ``ceil(test_size*n)`` validation rows first in a second seeded order (as D2's, by ``index_col`` where given)."""
    pos = _ordered(df, id_col, seed, TRAIN_VAL_SALT, buckets, index_col, n)
    n_val = F.ceil(F.col("n").cast("double") * F.lit(float(test_size))).cast("long")
    return pos.withColumn("split", F.when(F.col("pos") < n_val, F.lit("val")).otherwise(F.lit("train"))).drop("n")


def head_sample(df: DataFrame, n: int = EVAL_SAMPLES, order_col: str = "pos", dense: bool = True) -> DataFrame:
    """The first ``min(n, rows)`` rows in stored order.

    Positions of a split are consecutive (``dense``), so its head is a filter
    against the least one: no sort, and rows stay in their partitions.  Other
    orders take a top-k and are then dealt out again for what follows.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    if dense:
        return df.where(F.col(order_col) < df.select(F.min(order_col)).scalar() + n)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return df.orderBy(order_col).limit(n).repartition(parts, order_col)


def split_head(df: DataFrame, split: str, n: int = EVAL_SAMPLES, id_col: str | list[str] = "rid", train_ratio: float = TRAIN_RATIO,
               val_ratio: float = VAL_RATIO, seed: int = DEFAULT_SEED, buckets: int | None = None, index_col: str | None = None, rows: int | None = None) -> DataFrame:
    """D5 of a split of D2 without the split: its first ``min(n, rows)`` rows, with ``pos``.

    Where a split begins and ends follows from the number of rows and the ratios, so rows are ranked once and filtered.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    pos = _ordered(df, id_col, seed, None, buckets, index_col, rows)
    n_train, n_val = cut_points(F.col("n"), train_ratio, val_ratio)
    begins = {"train": F.lit(0), "val": n_train, "test": n_train + n_val}
    ends = {"train": n_train, "val": n_train + n_val, "test": F.col("n")}
    if split not in begins:
        raise ValueError(f"no split {split!r}")
    return pos.where((F.col("pos") >= begins[split]) & (F.col("pos") < F.least(begins[split] + n, ends[split]))).drop("n")
