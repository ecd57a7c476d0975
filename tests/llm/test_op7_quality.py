import re
from collections import Counter

from quire.llm import op7_quality as op


def brute_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {p for i, w in enumerate(windows) if count[w] > 1 for p in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_statistics_and_base_rules(odd_docs, odd_rows):
    got = {r.doc_id: r for r in op.quality(odd_docs, ["doc_id"]).collect()}
    for row in odd_rows:
        r, s = got[row[0]], brute_stats(row[1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == s
        assert r.base_failed == (s[0] < 20 or 100 * s[4] > 30 * s[0])
        assert not (r.base_failed and r.kept)


def test_adaptive_limits_reject_outliers_of_their_group(spark):
    plain = [(i, " ".join(f"word{(i * 7 + k * 13) % 97}x{k}" for k in range(40)), "en", "a") for i in range(60)]
    marks = [(100 + i, " ".join(f"word{k}x{i}***" for k in range(40)), "en", "b") for i in range(60)]
    docs = spark.createDataFrame([*plain, *marks, (999, marks[0][1], "en", "a")], "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in op.quality(docs, ["doc_id"]).collect()}
    assert not got[999]                          # unlike its own source
    assert all(v for k, v in got.items() if k != 999)   # but usual in the other


def test_sketches_merge(odd_docs):
    stats = op.text_stats(odd_docs)
    whole = {tuple(r) for r in op.merge(op.sketch(stats), []).collect()}
    halves = op.sketch(stats.where("doc_id % 2 = 0")).unionByName(op.sketch(stats.where("doc_id % 2 = 1")))
    assert {tuple(r) for r in op.merge(halves, []).collect()} == whole


def test_salted_join_gives_the_same(odd_docs):
    a = {tuple(r) for r in op.quality(odd_docs, ["doc_id"]).collect()}
    assert {tuple(r) for r in op.quality(odd_docs, ["doc_id"], max_broadcast=0).collect()} == a


def test_no_python_in_the_plan(odd_docs):
    plan = op.quality(odd_docs, ["doc_id"])._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", op.text_stats(odd_docs)._jdf.queryExecution().toString() + plan)


def test_clashing_columns_nulls_and_empty(clashing, no_docs):
    rows = op.quality(clashing, ["doc_id"]).collect()
    assert len(rows) == clashing.count()
    kept = op.keep_good(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == sum(r.kept for r in rows)
    assert op.quality(no_docs, ["doc_id"]).count() == 0
    assert op.keep_good(no_docs).count() == 0
