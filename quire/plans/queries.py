"""

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole input
tables.  Inputs are the fixtures of FIXTURES.md, derived from the tables by
Spark (``quire.sources.tables``).  Doubles are rounded to 6 places so an
independent SQL engine can be compared value by value (``oracle.py``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.template import ModelTemplate
from quire.operators import metrics as M
from quire.operators import profile as P
from quire.operators import prompts as PR
from quire.operators import split as D
from quire.operators import validate as V
from quire.operators.bootstrap import rouge_bootstrap
from quire.operators.position import stored_index
from quire.operators.predict import first_sentence_predictor, predict
from quire.plans.file_queries import FILE_QUERIES
from quire.plans.inputs import doc_clean, doc_pairs, lines, pairs, predictions, scored_pairs, validated
from quire.session import ensure_conf, scratch_path
from quire.sources import tables as T
from quire.sources.buckets import write_buckets

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6


def _r(c, name: str):
    return F.round(F.col(c) if isinstance(c, str) else c, DIGITS).alias(name)


def chat_lengths(df: DataFrame) -> DataFrame:
    """T1 over P1-rendered text."""
    return P.token_lengths(PR.profile_chat(df)).select("rid", "n_tokens")


# -- S1, S2, V1-V4 -----------------------------------------------------------

def s1_doc_lines(spark, sf):
    """S1's numbering and strip/skip rules over the stored document texts (one text = one file)."""
    from quire.sources.lines import text_lines

    docs = T.table(spark, sf, "documents").select(F.col("doc_id").alias("rid"), "text")
    return text_lines(docs, "rid")


def s2_strict_json(spark, sf):
    ensure_conf(spark)
    return V.parse_lines(lines(spark, sf)).select("idx", "parse_ok")


def doc_json_lines(spark, sf):
    """Whole document texts, of any characters, as JSON lines: question = first line, answer = the rest."""
    return doc_pairs(spark, sf).select("rid", F.to_json(F.struct("question", "answer", "domain")).alias("line"))


def s2_doc_json(spark, sf):
    ensure_conf(spark)
    return V.parse_lines(doc_json_lines(spark, sf)).select("rid", "parse_ok")


def v2_doc_json(spark, sf):
    """S2, V1 and V2 over JSON lines of whole document texts."""
    ensure_conf(spark)
    flat = V.validate_lines(doc_json_lines(spark, sf))
    return V.clean_records(flat, "rid")


def v1_reasons(spark, sf):
    return validated(spark, sf).select("idx", "reason")


def v1_doc_reasons(spark, sf):
    return V.validate_records(doc_pairs(spark, sf)).select("rid", "reason")


def v2_clean(spark, sf):
    return V.clean_records(validated(spark, sf))


def v2_doc_clean(spark, sf):
    return doc_clean(spark, sf).select("rid", "question", "answer", "domain")


def v3_rejects(spark, sf):
    return V.rejects(validated(spark, sf))


def v4_first_rejects(spark, sf):
    return V.first_rejects(V.rejects(validated(spark, sf)), 5)


# -- A1-A4 -------------------------------------------------------------------

def a1_counts(spark, sf):
    return P.ingest_counts(validated(spark, sf))


def a2_domains(spark, sf):
    return P.domain_histogram(V.clean_records(validated(spark, sf)))


def a2_doc_domains(spark, sf):
    return P.domain_histogram(doc_clean(spark, sf))


def a3_lengths(spark, sf):
    return P.mean_lengths(V.clean_records(validated(spark, sf)))


def a3_doc_lengths(spark, sf):
    return P.mean_lengths(doc_clean(spark, sf))


def a4_report(spark, sf):
    return P.ingest_report(validated(spark, sf))


# -- P1-P5 -------------------------------------------------------------------

def p1_chat_profile(spark, sf):
    return PR.profile_chat(pairs(spark, sf)).select("rid", "text")


def p2_plain(spark, sf):
    return PR.plain_prompt(pairs(spark, sf)).select("rid", "text")


def p3_chat_train(spark, sf):
    return PR.train_chat(pairs(spark, sf)).select("rid", "text")


# Chat templates of three shapes that public models carry (fixed values).
TEMPLATES = {
    "marked": ("{% for message in messages %}{{'<|im_start|>' + message['role'] + '\\n' + message['content'] + '<|im_end|>' + '\\n'}}{% endfor %}", {}),
    "headed": ("{% set loop_messages = messages %}{% for message in loop_messages %}{% set content = '<|start_header_id|>' + message['role'] + "
               "'<|end_header_id|>\\n\\n' + message['content'] | trim + '<|eot_id|>' %}{% if loop.index0 == 0 %}"
               "{% set content = bos_token + content %}{% endif %}{{ content }}{% endfor %}", {"bos_token": "<|begin_of_text|>"}),
    "tagged": ("{% for message in messages %}\n{% if message['role'] == 'user' %}\n{{ '<|user|>\\n' + message['content'] + eos_token }}\n"
               "{% elif message['role'] == 'system' %}\n{{ '<|system|>\\n' + message['content'] + eos_token }}\n"
               "{% elif message['role'] == 'assistant' %}\n{{ '<|assistant|>\\n' + message['content'] + eos_token }}\n{% endif %}\n{% endfor %}",
               {"eos_token": "</s>"}),
}


def p1_model_chat(spark, sf):
    """P1 by models' own templates, over whole documents."""
    docs = doc_clean(spark, sf)
    texts = [PR.profile_chat(docs, ModelTemplate(source, names)).select("rid", F.lit(name).alias("template"), "text")
             for name, (source, names) in TEMPLATES.items()]
    return texts[0].unionByName(texts[1]).unionByName(texts[2])


def p4_infer(spark, sf):
    return PR.inference_prompt(pairs(spark, sf)).select("rid", "prompt")


def p5_strip(spark, sf):
    """P5 over whole document texts, which carry untrimmed whitespace of many kinds."""
    docs = T.table(spark, sf, "documents")
    return docs.select(F.col("doc_id").alias("rid"), PR.strip_completion("text").alias("completion"))


# -- T1-T4 -------------------------------------------------------------------

def t1_tokens(spark, sf):
    return chat_lengths(pairs(spark, sf))


def t1_subword(spark, sf, tokenizer: str = "byte_bpe_50k.json"):
    """T1 by a subword tokenizer over whole document texts."""
    import public_tokenizers

    docs = T.table(spark, sf, "documents").select(F.col("doc_id").alias("rid"), "text")
    return P.token_lengths(docs, counter=P.tokenizer_counter(public_tokenizers.path(tokenizer))).select("rid", "n_tokens")


def t2_overlimit(spark, sf):
    return P.flag_over_limit(chat_lengths(pairs(spark, sf)))


def _report(df):
    rep = P.length_report(df)
    return rep.select("n", _r("mean_tokens", "mean_tokens"), "max_tokens", "p95_tokens", "n_over",
                      _r("pct_over", "pct_over"))


def t3_report(spark, sf):
    return _report(chat_lengths(pairs(spark, sf)))


def t3_doc_report(spark, sf):
    return _report(chat_lengths(doc_clean(spark, sf)))


def t4_p95(spark, sf):
    return P.exact_quantile(chat_lengths(pairs(spark, sf)))


def t4_doc_answer_p95(spark, sf):
    """p95 of the answer word count of the document pairs (long texts)."""
    d = P.token_lengths(doc_clean(spark, sf), text_col="answer")
    return P.exact_quantile(d)


# -- D1-D5 -------------------------------------------------------------------

def d1_shuffle(spark, sf):
    return D.shuffle_positions(pairs(spark, sf).select("rid")).select("rid", "pos")


def d2_split(spark, sf):
    return D.three_way_split(pairs(spark, sf).select("rid")).select("rid", "pos", "split")


def d3_sizes(spark, sf):
    return D.split_sizes(pairs(spark, sf))


def d4_trainval(spark, sf):
    return D.train_val_split(pairs(spark, sf).select("rid")).select("rid", "pos", "split")


def d5_head(spark, sf):
    return D.split_head(pairs(spark, sf).select("rid"), "test", D.EVAL_SAMPLES).select("rid", "pos")


def stored_docs(spark, sf):
    """Clean document pairs written in the order of their ids and numbered as stored."""
    path = scratch_path(spark, "docs")
    doc_clean(spark, sf).repartitionByRange("rid").sortWithinPartitions("rid").write.parquet(path)
    return stored_index(spark, path)


def _record():
    """What shows that a position came to its whole record."""
    return F.md5(F.concat_ws("\n", "question", "answer", "domain")).alias("record")


def d1_dense_shuffle(spark, sf):
    """D1 over numbered rows: no sort, window or shuffle of records or ids."""
    return D.dense_positions(stored_docs(spark, sf), "idx").select("rid", "idx", "pos", _record())


def d2_dense_split(spark, sf):
    return D.three_way_split(stored_docs(spark, sf), index_col="idx").select("rid", "pos", "split", _record())


def d4_dense_trainval(spark, sf):
    return D.train_val_split(stored_docs(spark, sf), index_col="idx").select("rid", "pos", "split", _record())


# -- E1-E7 -------------------------------------------------------------------

def e1_predict(spark, sf):
    return predict(pairs(spark, sf), {"stub": first_sentence_predictor})


def e2_pairs(spark, sf):
    return scored_pairs(spark, sf)


def e2_stored_pairs(spark, sf):
    """E2 without a shuffle: both sides stored in buckets of ``rid``."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    preds, refs = write_buckets(predictions(spark, sf), "rid", n, "predictions"), write_buckets(pairs(spark, sf), "rid", n, "references")
    return M.pair_stored(spark.table(preds), spark.table(refs))


def e3_bleu(spark, sf):
    b = M.bleu(scored_pairs(spark, sf))
    return b.select("label", _r("bleu", "bleu"), _r("brevity_penalty", "brevity_penalty"),
                    "m1", "m2", "m3", "m4", "t1", "t2", "t3", "t4", "pred_len", "ref_len")


def e4_rouge_n(spark, sf):
    r = M.rouge_n(scored_pairs(spark, sf))
    return r.select("label", _r("rouge1", "rouge1"), _r("rouge2", "rouge2"))


def e4_rouge_bootstrap(spark, sf):
    """ROUGE as the reference's metric reports it: middle and 95% limits of 1,000 bootstrap replicates."""
    limits = rouge_bootstrap(M.row_scores(scored_pairs(spark, sf), bleu=False))
    return limits.select("label", "metric", *[_r(c, c) for c in ("low", "mid", "high")])


def e5_rouge_l(spark, sf):
    return M.rouge_l(scored_pairs(spark, sf)).select("label", _r("rougeL", "rougeL"))


def e6_metrics(spark, sf):
    return M.metric_table(scored_pairs(spark, sf)).select("label", *M.METRICS)


def scored_docs(spark, sf):
    """E2 on long texts: the answers are whole documents."""
    long_pairs = doc_clean(spark, sf).select("rid", "question", "answer")
    return M.pair_predictions(T.predictions_fixture(long_pairs).select("label", "rid", "prediction"), long_pairs)


def e5_doc_rouge_l(spark, sf):
    """E5 over whole documents.  SQL cannot score texts of this length; a test holds it against brute force."""
    return M.rouge_l(scored_docs(spark, sf)).select("label", _r("rougeL", "rougeL"))


def e6_doc_metrics(spark, sf):
    """E6 over long texts; their ROUGE-L is ``e5_doc_rouge_l``."""
    return M.metric_table(scored_docs(spark, sf), lcs=False).select("label", "bleu", "rouge1", "rouge2")


def e7_compare(spark, sf):
    return M.compare(M.metric_table(scored_pairs(spark, sf)))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in [
        s1_doc_lines, s2_strict_json, s2_doc_json, v2_doc_json, v1_reasons, v1_doc_reasons, v2_clean, v2_doc_clean, v3_rejects, v4_first_rejects,
        a1_counts, a2_domains, a2_doc_domains, a3_lengths, a3_doc_lengths, a4_report,
        p1_chat_profile, p2_plain, p3_chat_train, p1_model_chat, p4_infer, p5_strip,
        t1_tokens, t1_subword, t2_overlimit, t3_report, t3_doc_report, t4_p95, t4_doc_answer_p95,
        d1_shuffle, d2_split, d3_sizes, d4_trainval, d5_head, d1_dense_shuffle, d2_dense_split, d4_dense_trainval,
        e1_predict, e2_pairs, e2_stored_pairs, e3_bleu, e4_rouge_n, e4_rouge_bootstrap, e5_rouge_l, e5_doc_rouge_l, e6_metrics, e6_doc_metrics, e7_compare,
    ]
} | FILE_QUERIES
