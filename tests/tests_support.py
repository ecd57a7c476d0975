from pyspark.sql import functions as F


def col_values(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def lines_df(spark, lines):
    return spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "idx long, line string")


def plan_text(df) -> str:
    """The physical plan as text, through the public ``explain``."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()
