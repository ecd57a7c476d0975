"""Sample Q&A source (S4): ``n`` rows, each a uniform pick of a topic and then
of one of its three pairs, reproducible from a seed.

The reference draws with Python's generator; here each pick is a hash of
``(row, seed)``, so every executor computes its rows independently and the
result is the same on any partitioning.  The 9-row seed table is a fixed
size and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The reference's three sample topics (used as the domain).
TOPICS = ["machine learning", "deep learning", "natural language processing"]

# Our own sample pairs, three per topic (not the reference's wording).
SEED_PAIRS = {
    "machine learning": [
        ("What does a validation set measure?",
         "A validation set estimates how well a model does on data it was not fitted on, and guides choices such as "
         "hyperparameters before the final test."),
        ("Why scale input features?",
         "Scaling puts features on comparable ranges so that distance-based methods and gradient steps are not "
         "dominated by the feature with the largest units."),
        ("What is a decision tree?",
         "A decision tree splits the data by one feature at a time, choosing each split to make the groups purer, "
         "and predicts from the leaf a row falls into."),
    ],
    "deep learning": [
        ("What is an activation function?",
         "An activation function applies a non-linear map to a layer's output, which lets stacked layers represent "
         "functions a single linear map cannot."),
        ("Why use residual connections?",
         "Residual connections add a layer's input to its output, which keeps gradients flowing through very deep "
         "networks and makes them easier to train."),
        ("What does a learning rate schedule do?",
         "A schedule changes the step size during training, for example warming up and then decaying it, to train "
         "fast early on and settle precisely later."),
    ],
    "natural language processing": [
        ("What is a language model?",
         "A language model assigns probabilities to sequences of tokens, usually by predicting each next token from "
         "the ones before it."),
        ("What are word embeddings?",
         "Word embeddings are dense vectors learned so that words used in similar contexts end up close to each "
         "other in the vector space."),
        ("What is named entity recognition?",
         "Named entity recognition finds spans of text that name people, places, organisations and similar things, "
         "and labels each span with its type."),
    ],
}


def _pick(spark_id: Column, seed: int, what: str, k: int) -> Column:
    h = F.md5(F.concat(spark_id.cast("string"), F.lit(f":{seed}:{what}")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % k).cast("int")


def seed_table(spark: SparkSession) -> DataFrame:
    rows = [(t, j, q, a, topic) for t, topic in enumerate(TOPICS) for j, (q, a) in enumerate(SEED_PAIRS[topic])]
    return spark.createDataFrame(rows, "t int, k int, question string, answer string, domain string")


def sample_qa(spark: SparkSession, n: int = 500, seed: int = 42) -> DataFrame:
    """``(rid, question, answer, domain)`` for ``rid`` in 0..n-1."""
    ids = spark.range(n).select(F.col("id").alias("rid"))
    picks = ids.select("rid", _pick(F.col("rid"), seed, "topic", len(TOPICS)).alias("t"),
                       _pick(F.col("rid"), seed, "pair", 3).alias("k"))
    return picks.join(F.broadcast(seed_table(spark)), ["t", "k"]).select("rid", "question", "answer", "domain")
