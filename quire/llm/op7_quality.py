"""Quality rules whose limits come from the corpus: mergeable quantile sketches per language and source.

Fixed base rules reject what is broken anywhere (too short, mostly repeated).
The other limits are adaptive.  For each (language, source) a sketch of every
measure is built from the documents that pass the base rules; a document is
rejected when a measure lies beyond the fences ``q25 - spread`` / ``q75 +
spread`` with ``spread = iqr_factor * (q75 - q25) + slack``.

The sketch is a log-linear histogram: a value keeps its ``SKETCH_BITS`` leading
bits, the rest is cut off, so a quantile is at most 1/32 too low, whatever the
distribution.  It is a table of (language, source, measure, cut value, count);
two sketches merge by adding counts.  So partial aggregation builds it on the
map side, the result does not depend on the order of rows, and sketches of
thin groups are replaced by the merged sketch of their language, then by that
of all documents.

Everything is DataFrame functions; the plan has no Python node.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import checkpointed, counted_broadcast, let, word_array

SYMBOL = "[#*$%&|<>]"
SPACE_CHAR = r"[\x20\x09-\x0D]"
NO_SPACE = r"[^\x20\x09-\x0D]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SKETCH_BITS = 6
# Thinner groups take the merged sketch of their language, thinner languages that of all documents.
MIN_GROUP = 30
# A fence row is under 300 bytes: 15 MB at most are broadcast; beyond it documents are joined by a salted key.
MAX_BROADCAST_GROUPS = 50_000
SALTS = 64

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Measure:
    """An integer measure: its expression, the slack of its fences, and whether it has a lower fence."""

    name: str
    expr: str
    slack: int
    two_sided: bool = False


MEASURES = (
    Measure("symbols", "1000 * _q_symbols div greatest(_q_chars, 1)", 40),
    Measure("word_length", "100 * _q_chars div greatest(_q_words, 1)", 150, True),
    Measure("dup_lines", "1000 * _q_dup div greatest(_q_lines, 1)", 400),
    Measure("repeats", "1000 * _q_repeat div greatest(_q_words, 1)", 300),
)


def _windows(hashes: Column) -> Column:
    """Hashes of all windows of ``WINDOW`` words: pairs of words, pairs of pairs, and so on by doubling."""
    def pairs(of: Column, apart: int) -> Column:
        return F.transform(of, lambda x, i: F.xxhash64(x, F.get(of, i + apart)))

    def doubled(of: Column, size: int) -> Column:
        if size == WINDOW:
            return F.slice(of, F.lit(1), F.greatest(F.size(of) - (WINDOW - 1), F.lit(0)))
        return let(pairs(of, size), lambda x: doubled(x, 2 * size))

    return doubled(hashes, 1)


def _covered(windows: Column) -> Column:
    """Words that lie in a window occurring twice or more.  Most texts repeat no window: only those that do are sorted."""
    def words(starts: Column) -> Column:
        first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(starts, first, lambda a, i: F.struct(
            (a["n"] + i + WINDOW - F.greatest(i, a["end"])).cast("long").alias("n"), (i + WINDOW).alias("end")), lambda a: a["n"])

    def starts(runs: Column) -> Column:  # (hash, position) in hash order: equal neighbours are repeated windows
        again = F.filter(runs, lambda e, k: ((k > 0) & (F.get(runs, k - 1)["h"] == e["h"]))
                         | F.coalesce(F.get(runs, k + 1)["h"] == e["h"], F.lit(False)))
        return F.array_sort(F.transform(again, lambda e: e["i"]))

    placed = F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), words(let(F.array_sort(placed), starts))).otherwise(
        F.lit(0).cast("long"))


def text_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_q_words, _q_chars, _q_symbols, _q_lines, _q_dup, _q_repeat`` (long) of the whole text.

    A null text counts as empty.  Windows are compared by 64-bit hashes of
    their words' 64-bit hashes, within one document.
    """
    t = F.coalesce(F.col(text_col), F.lit(""))

    def of_words(words: Column) -> Column:
        hashes = F.transform(words, lambda w: F.xxhash64(w))
        return F.struct(F.size(words).cast("long").alias("n"),
                        let(hashes, lambda h: let(_windows(h), _covered)).alias("repeat"))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("dup"))

    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(NO_SPACE))
    return docs.withColumns({
        "_q_w": let(word_array(F.col(text_col)), of_words), "_q_l": let(lines, of_lines),
        "_q_chars": (F.length(t) - F.regexp_count(t, F.lit(SPACE_CHAR))).cast("long"),
        "_q_symbols": F.regexp_count(t, F.lit(SYMBOL)).cast("long"),
    }).withColumns({"_q_words": F.col("_q_w.n"), "_q_repeat": F.col("_q_w.repeat"),
                    "_q_lines": F.col("_q_l.n"), "_q_dup": F.col("_q_l.dup")}).drop("_q_w", "_q_l")


def base_failed() -> Column:
    words = F.col("_q_words")
    return (words < MIN_WORDS) | (100 * F.col("_q_repeat") > MAX_REPEAT_PERCENT * words)


def sketch(stats: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``(_lang, _source, measure, value, count)``: one mergeable sketch per group and measure."""
    values = F.array(*[F.struct(F.lit(m.name).alias("measure"), F.expr(m.expr).alias("v")) for m in MEASURES])
    rows = stats.where(~base_failed()).select(
        F.col(lang).cast("string").alias("_lang"), F.col(source).cast("string").alias("_source"), F.inline(values))
    cut = rows.withColumn("_shift", F.expr(f"greatest(0, length(bin(v)) - {SKETCH_BITS})"))
    return cut.groupBy("_lang", "_source", "measure", F.expr("shiftleft(shiftright(v, _shift), _shift)").alias("value")).agg(
        F.count(F.lit(1)).alias("count"))


def merge(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches merged over all groups that agree on ``by``: counts of equal values add up."""
    return sketches.groupBy(*by, "measure", "value").agg(F.sum("count").alias("count"))


def _quantiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """``q25``, ``q75`` and ``n`` per group and measure.  A sketch has a few hundred rows at most, so its window is small."""
    w = Window.partitionBy(*by, "measure")
    cum = sketches.withColumn("_cum", F.sum("count").over(w.orderBy("value"))).withColumn("_n", F.sum("count").over(w))
    return cum.groupBy(*by, "measure").agg(
        F.max("_n").alias("n"),
        *[F.min(F.when(100 * F.col("_cum") >= q * F.col("_n"), F.col("value"))).alias(f"q{q}") for q in (25, 75)])


def fences(sketches: DataFrame, min_group: int = MIN_GROUP, iqr_factor: int = 3) -> DataFrame:
    """``(_lang, _source, <measure>_lo, <measure>_hi ...)``: one row per group of the sketches."""
    own = _quantiles(sketches, ["_lang", "_source"])
    lang = _quantiles(merge(sketches, ["_lang"]), ["_lang"]).select(
        F.col("_lang").alias("_l"), F.col("measure").alias("_m"), *[F.col(c).alias(f"l_{c}") for c in ("n", "q25", "q75")])
    # One row per measure: joined by a key, four rows in all.
    every = _quantiles(merge(sketches, []), []).select(
        F.col("measure").alias("_e"), *[F.col(c).alias(f"e_{c}") for c in ("q25", "q75")])
    joined = own.join(lang, own["_lang"].eqNullSafe(lang["_l"]) & (own["measure"] == lang["_m"])).join(
        F.broadcast(every), F.col("measure") == F.col("_e"))

    def pick(c: str) -> Column:
        return F.when(F.col("n") >= min_group, F.col(c)).when(F.col("l_n") >= min_group, F.col(f"l_{c}")).otherwise(F.col(f"e_{c}"))

    spread = iqr_factor * (F.col("_hi") - F.col("_lo"))
    chosen = joined.select("_lang", "_source", "measure", pick("q25").alias("_lo"), pick("q75").alias("_hi"))
    columns = []
    for m in MEASURES:
        this = F.col("measure") == m.name
        low = F.col("_lo") - spread - m.slack if m.two_sided else F.lit(-1)
        columns += [F.max(F.when(this, low)).cast("long").alias(f"_{m.name}_lo"),
                    F.max(F.when(this, F.col("_hi") + spread + m.slack)).cast("long").alias(f"_{m.name}_hi")]
    return chosen.groupBy("_lang", "_source").agg(*columns)


def quality(docs: DataFrame, keys: list[str], text_col: str = "text", lang: str = "lang", source: str = "source",
            min_group: int = MIN_GROUP, max_broadcast: int = MAX_BROADCAST_GROUPS) -> DataFrame:
    """The columns ``keys`` of every row plus the five statistics, ``base_failed`` and ``kept``.

    Texts are measured once; the narrow statistics are checkpointed, so the
    sketches and the verdicts read them and not the texts.  The fence table
    is written and counted.  Up to ``max_broadcast`` groups it is broadcast,
    beyond that joined by (group, salt), so that a group holding a third of
    the documents is spread.

    Null text: empty, so ``base_failed``.  Null language or source: a group of
    its own.  Repeated rows each count and each get a verdict.  An empty table
    gives an empty result.  Columns that are not named are not read, so their
    names cannot clash; ``keys`` must not hold a name that is added here.
    """
    narrow = docs.select(*[F.col(k) for k in keys], F.col(lang).cast("string").alias("_q_lang"),
                         F.col(source).cast("string").alias("_q_source"), F.col(text_col).cast("string").alias("_q_text"))
    stats = checkpointed(text_stats(narrow, "_q_text").drop("_q_text"))
    limits = checkpointed(fences(sketch(stats, "_q_lang", "_q_source"), min_group))
    match = F.col("_q_lang").eqNullSafe(F.col("_lang")) & F.col("_q_source").eqNullSafe(F.col("_source"))
    if limits.limit(max_broadcast + 1).count() <= max_broadcast:
        joined = stats.join(F.broadcast(limits), match, "left")
    else:
        salted = limits.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        stats = stats.withColumn("_q_salt", F.pmod(F.xxhash64(*keys), F.lit(SALTS)).cast("int"))
        joined = stats.join(salted, match & (F.col("_q_salt") == F.col("_salt")), "left")
    inside = F.lit(True)
    for m in MEASURES:
        value = F.expr(m.expr)
        inside = inside & (value >= F.col(f"_{m.name}_lo")) & (value <= F.col(f"_{m.name}_hi"))
    failed = base_failed()
    kept = F.when(failed, F.lit(False)).otherwise(F.coalesce(inside, F.lit(True)))
    names = dict(zip(STATS, ("_q_words", "_q_chars", "_q_symbols", "_q_dup", "_q_repeat"), strict=True))
    return joined.select(*[F.col(k) for k in keys], *[F.col(c).alias(s) for s, c in names.items()],
                         failed.alias("base_failed"), kept.alias("kept"))


def keep_good(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` whose verdict is ``kept``.

    A verdict follows from a row's values, so rejected rows are named by two
    64-bit hashes of all columns: few are broadcast, many are joined by them.
    """
    names = ["_row", "_row2"]
    columns = [F.col(c) for c in docs.columns]
    hashed = docs.withColumns({"_row": F.xxhash64(*columns), "_row2": F.xxhash64(F.lit(1), *columns)})
    bad = checkpointed(quality(hashed, names, **settings).where(~F.col("kept")).select(*names).distinct())
    return hashed.join(counted_broadcast(bad), names, "left_anti").select(*docs.columns)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])


STAT_SQL = r"""
  raw AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
  worded AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
               list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM raw),
  win AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM worded WHERE len(w) >= 8)),
  dupwin AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
  rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM dupwin) GROUP BY rid),
  st AS (SELECT worded.rid, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           len(ln)::BIGINT AS n_lines, (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines,
           coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM worded LEFT JOIN rep USING (rid)),
  fl AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM st),
  m AS (SELECT rid, lang, source, base_failed, unnest(['symbols', 'word_length', 'dup_lines', 'repeats']) AS measure,
          unnest([1000 * n_symbols // greatest(word_chars, 1), 100 * word_chars // greatest(n_words, 1),
                  1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_repeat_words // greatest(n_words, 1)]) AS v FROM fl),
  sk AS (SELECT lang, source, measure, (v >> s) << s AS value, count(*) AS c
         FROM (SELECT *, greatest(0, length(bin(v)) - 6)::BIGINT AS s FROM m WHERE NOT base_failed) GROUP BY ALL),
"""

QUANTILE_SQL = """
  {name} AS (SELECT {by} measure, max(n) AS n, min(CASE WHEN 100 * cum >= 25 * n THEN value END) AS q25,
             min(CASE WHEN 100 * cum >= 75 * n THEN value END) AS q75
           FROM (SELECT {by} measure, value, sum(c) OVER (PARTITION BY {by} measure ORDER BY value) AS cum,
                        sum(c) OVER (PARTITION BY {by} measure) AS n
                 FROM (SELECT {by} measure, value, sum(c) AS c FROM sk GROUP BY ALL)) GROUP BY ALL),
"""

ORACLE = ("WITH" + STAT_SQL + QUANTILE_SQL.format(name="qo", by="lang, source,") + QUANTILE_SQL.format(name="ql", by="lang,")
          + QUANTILE_SQL.format(name="qa", by="") + """
  pick AS (SELECT qo.lang, qo.source, qo.measure,
             CASE WHEN qo.n >= 30 THEN qo.q25 WHEN ql.n >= 30 THEN ql.q25 ELSE qa.q25 END AS lo,
             CASE WHEN qo.n >= 30 THEN qo.q75 WHEN ql.n >= 30 THEN ql.q75 ELSE qa.q75 END AS hi
           FROM qo JOIN ql ON qo.lang IS NOT DISTINCT FROM ql.lang AND qo.measure = ql.measure JOIN qa ON qa.measure = qo.measure),
  fence AS (SELECT lang, source, measure, CASE WHEN measure = 'word_length' THEN lo - 3 * (hi - lo) - 150 ELSE -1 END AS low,
              hi + 3 * (hi - lo) + CASE measure WHEN 'symbols' THEN 40 WHEN 'word_length' THEN 150 WHEN 'dup_lines' THEN 400 ELSE 300 END AS high
            FROM pick),
  bad AS (SELECT DISTINCT rid FROM m JOIN fence f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source
            AND m.measure = f.measure WHERE v < low OR v > high)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND bad.rid IS NULL) AS kept FROM fl LEFT JOIN bad USING (rid)
""")
