"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies.  Among all
rates in (0, ``max_copies``] that give each source its target number of words,
entropy balancing takes those closest to 1 (least Kullback-Leibler
divergence).  The convex dual has one multiplier a source; its solution tilts
the documents of source s exponentially by their size:

    rate(d) = min(max_copies, exp(lambda_s * size(d) / mean_size_s))

Newton iterations solve the dual.  Each is one distributed aggregation over
the histogram (source, size, documents), which holds all that the dual needs
of a source, however many documents it has; multipliers stay in a table.  A
bracket around each root turns a step that would leave it into a bisection.

Rates become whole copies by error diffusion over the same histogram, one row
per size, largest sizes first: the copies of all documents of a size are the
words their rates say plus the error carried so far, rounded to whole copies,
up or down as the smaller sizes can take up what is over.  So a source misses
its target by about half the size of its smallest documents, and by more only where one document
outweighs all that the smaller ones can take up (or there are hardly any
documents): documents are taken whole, never in part.  The copies of a size are dealt evenly to its documents,
which are cut into hash buckets of bounded size; each bucket starts where the
running sum of the buckets before it ends, so a hot size is spread over tasks.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import checkpointed, counted_broadcast, n_words

WEIGHTS = (3, 1, 2)       # by the source's place in code point order, repeating
SHARE = 1.5               # of all sizes
MAX_COPIES = 2
BUCKET_ROWS = 2_000       # documents of one size that are numbered together, by one task
MAX_ROUNDS = 80
TOLERANCE = 1e-9          # of a source's target


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: int = MAX_COPIES) -> DataFrame:
    """``(source, source_size, target)`` from rows of ``(source, size)``; one row per source, null last.

    Targets share ``share`` of all sizes by weight.  A target stops at ``cap``
    times its source's size, and the excess is shared again by weight.  That
    is water filling: in order of ``cap * size / weight`` the sources up to
    some place stop, and the others share what is left.  Both running sums
    are over one row per source.  Names are ranked by a window over the
    sources, not over their documents.
    """
    names = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (at % len(weights) + 1).cast("int"))
    rows = names.withColumn("_w", weight).withColumn("_cap", F.lit(float(cap)) * F.col("source_size")).withColumn(
        "_ratio", F.col("_cap") / F.col("_w"))
    order = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rows = rows.withColumns({
        "_total": share * F.sum("source_size").over(every),
        "_caps": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
        "_open": F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)),
    })
    # The level if all sources before this one stop at their cap and it and the others do not.
    rows = rows.withColumn("_level", (F.col("_total") - F.col("_caps")) / F.col("_open"))
    level = F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(every)
    return rows.withColumn("target", F.least(F.col("_cap"), F.coalesce(F.col("_w") * level, F.col("_cap")))).select(
        "source", "source_size", "target")


def solve(histogram: DataFrame, targets: DataFrame, cap: int = MAX_COPIES, max_rounds: int = MAX_ROUNDS,
          tolerance: float = TOLERANCE) -> DataFrame:
    """``(source, scale, lam)`` by Newton iterations; ``histogram``: ``(source, size, docs)``, size > 0.

    A source whose target is its cap (or 0) has no finite multiplier: it gets
    plus (or minus) infinity.
    """
    mean = histogram.groupBy("source").agg((F.sum(F.col("size") * F.col("docs")) / F.sum("docs")).alias("scale"))
    base = targets.where("source_size > 0").join(mean, targets["source"].eqNullSafe(mean["source"])).select(
        targets["source"], "scale", "target", F.col("source_size").cast("double").alias("_size"))
    full = F.col("target") >= cap * F.col("_size") * (1 - 1e-12)
    state = checkpointed(base.select(
        "source", "scale", "target",
        F.when(full, F.lit(float("inf"))).when(F.col("target") <= 0, F.lit(float("-inf"))).otherwise(F.lit(0.0)).alias("lam"),
        (full | (F.col("target") <= 0)).alias("done"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high")))
    kept = ["source", "scale", "target", "lam", "done", "low", "high"]
    for _ in range(max_rounds):
        if state.where("not done").limit(1).count() == 0:
            break
        # One row per source meets the histogram; its columns are the group, so the sums come with the state.
        s = counted_broadcast(state.withColumnRenamed("source", "_s"))
        rate = F.least(F.lit(float(cap)), F.exp(F.least(F.col("lam") * F.col("size") / F.col("scale"), F.lit(50.0))))
        words = F.col("size") * F.col("docs") * rate
        j = histogram.join(s, F.col("source").eqNullSafe(F.col("_s"))).groupBy(*kept).agg(
            (F.sum(words) - F.col("target")).alias("_f"),
            F.sum(F.when(rate < cap, words * F.col("size") / F.col("scale")).otherwise(F.lit(0.0))).alias("_slope"))
        j = j.withColumns({
            "low": F.when(~F.col("done") & (F.col("_f") < 0), F.col("lam")).otherwise(F.col("low")),
            "high": F.when(~F.col("done") & (F.col("_f") > 0), F.col("lam")).otherwise(F.col("high")),
            "_done": F.col("done") | (F.abs("_f") <= tolerance * F.col("target")),
            "_newton": F.when(F.col("_slope") > 0, F.col("lam") - F.col("_f") / F.col("_slope")),
        })
        # No bracket on one side yet: a step may double the distance from 0, plus 1.
        lo = F.coalesce(F.col("low"), -2 * F.abs("lam") - 1)
        hi = F.coalesce(F.col("high"), 2 * F.abs("lam") + 1)
        step = F.when((F.col("_newton") > lo) & (F.col("_newton") < hi), F.col("_newton")).otherwise(
            F.when(F.col("low").isNull(), lo).when(F.col("high").isNull(), hi).otherwise((lo + hi) / 2))
        # A bracket without a number between its ends is solved as far as doubles go.
        tight = F.col("low").isNotNull() & F.col("high").isNotNull() & (F.abs(F.col("high") - F.col("low")) <= 1e-14 * (1 + F.abs("lam")))
        state = checkpointed(j.select(
            "source", "scale", "target", F.when(F.col("_done") | tight, F.col("lam")).otherwise(step).alias("lam"),
            (F.col("_done") | tight).alias("done"), "low", "high"))
    return state.select("source", "scale", "lam")


def whole_copies(sizes: list[int], docs: list[int], rates: list[float], cap: int) -> list[int]:
    """Copies of all documents of each size.  ``sizes`` of one source, largest first, with their numbers of documents and rates."""
    room = [cap * n for n in docs]
    less, more = [0.0] * (len(sizes) + 1), [0.0] * (len(sizes) + 1)  # what the sizes from a place on can give up or add
    for i in range(len(sizes) - 1, -1, -1):
        words = sizes[i] * docs[i] * rates[i]
        less[i], more[i] = less[i + 1] + words, more[i + 1] + sizes[i] * room[i] - words
    copies, error = [], 0.0
    for i, (s, n, r) in enumerate(zip(sizes, docs, rates, strict=True)):
        want = s * n * r + error
        near = min(room[i], max(0, int(want / s + 0.5)))
        other = min(room[i], max(0, near + (1 if want > near * s else -1)))
        copies.append(next((k for k in (near, other) if -more[i + 1] <= k * s - want <= less[i + 1]), near))
        error = want - copies[i] * s
    return copies


def deal(histogram: DataFrame, cap: int) -> DataFrame:
    """``(source, size, docs, rate, copies)`` from rows of ``(source, size, docs, rate)``: the copies of all documents of a size.

    A task holds one source's distinct sizes, five numbers each: as many as its longest text has words at most, whatever
    the number of its documents.
    """
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "descending")])
        copies = whole_copies(*(group.column(c).to_pylist() for c in ("size", "docs", "rate")), cap)
        return group.append_column("copies", pa.array(copies, pa.int64()))

    schema = "source string, size bigint, docs bigint, rate double, copies bigint"
    return histogram.select("source", "size", "docs", "rate").groupBy("source").applyInArrow(run, schema)


def mix(docs: DataFrame, source_col: str = "source", text_col: str = "text", keys: list[str] | None = None,
        weights: tuple = WEIGHTS, share: float = SHARE, cap: int = MAX_COPIES) -> DataFrame:
    """The columns ``keys`` of every row plus ``size, source_size, target, rate, copies, taken``; ``taken`` = ``copies * size``.

    Null or empty text: size 0, rate 1, no copy.  A null source is a source of
    its own, in the last place.  Repeated rows are documents of their own;
    rows that are equal in all of ``keys`` get their copies in any order.  A
    source without words has target 0.  An empty table gives an empty result.
    ``keys`` (default: ``doc_id``) must not hold the columns added here.
    """
    keys = keys or ["doc_id"]
    sized = checkpointed(docs.select(*keys, F.col(source_col).cast("string").alias("_source"), n_words(F.col(text_col)).alias("_n")))
    rows = sized.select(F.col("_source").alias("source"), F.col("_n").alias("size"))
    targets = checkpointed(source_targets(rows, weights, share, cap))
    histogram = checkpointed(rows.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")))
    lam = solve(histogram, targets, cap)
    z = F.when(F.abs("lam") == float("inf"), F.col("lam")).otherwise(F.col("lam") * F.col("size") / F.col("scale"))
    rate = F.least(F.lit(float(cap)), F.exp(F.least(z, F.lit(50.0))))
    rated = histogram.join(counted_broadcast(checkpointed(lam.withColumnRenamed("source", "_t"))), F.col("source").eqNullSafe(F.col("_t")))
    dealt = checkpointed(deal(rated.withColumn("rate", F.coalesce(rate, F.lit(1.0))), cap))
    sized = sized.join(counted_broadcast(targets.withColumnRenamed("source", "_t")), F.col("_source").eqNullSafe(F.col("_t"))).drop("_t")
    per_size = dealt.select(F.col("source").alias("_t"), F.col("size").alias("_size"), F.col("docs").alias("_docs"), F.col("rate"),
                            F.col("copies").alias("_copies"))
    joined = sized.where("_n > 0").join(counted_broadcast(per_size), F.col("_source").eqNullSafe(F.col("_t")) & (F.col("_n") == F.col("_size")))
    cut = joined.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.ceil(F.col("_docs") / BUCKET_ROWS))).drop("_t", "_size")
    # A bucket's first place is the number of documents in the buckets before it; sizes of one bucket start at 0.
    sums = cut.where(F.col("_docs") > BUCKET_ROWS).groupBy("_source", "_n", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_source", "_n").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = checkpointed(sums.select(F.col("_source").alias("_s"), F.col("_n").alias("_m"), F.col("_bucket").alias("_b"),
                                      F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy("_source", "_n", "_bucket").orderBy(F.xxhash64(*keys), *[F.col(k) for k in keys])
    ranked = cut.withColumn("_rank", F.row_number().over(inside)).join(
        counted_broadcast(starts), F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_n") == F.col("_m")) & (F.col("_bucket") == F.col("_b")), "left")
    ranked = ranked.withColumn("_place", F.coalesce(F.col("_start"), F.lit(0)) + F.col("_rank"))  # from 1
    ranked = ranked.withColumn("copies", F.expr("_place * _copies div _docs - (_place - 1) * _copies div _docs"))
    kept = [F.col(k) for k in keys] + [F.col("_n").alias("size"), "source_size", "target", "rate", "copies"]
    empty = sized.where("_n = 0").withColumns({"rate": F.lit(1.0), "copies": F.lit(0).cast("long")})
    return ranked.select(*kept).unionByName(empty.select(*kept)).withColumn("taken", F.col("copies") * F.col("size"))


def repeat(docs: DataFrame, text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """The mix itself: each row of ``docs``, whole, as often as it has copies.

    Rows are named by the hash of all columns; rows that share it are equal, and each takes one of their results.
    """
    # Under names of its own, so that no column clashes with the result's.
    place = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    hashed = docs.toDF(*place.values()).withColumn("_row", F.xxhash64(*place.values()))
    found = mix(hashed, place[source_col], place[text_col], ["_row"], **settings).select("_row", "copies")
    left = hashed.withColumn("_nth", F.row_number().over(Window.partitionBy("_row").orderBy(F.lit(1))))
    right = found.withColumn("_nth", F.row_number().over(Window.partitionBy("_row").orderBy("copies"))).where("copies > 0")
    rows = left.join(right, ["_row", "_nth"]).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select(*[F.col(place[c]).alias(c) for c in docs.columns])


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")
