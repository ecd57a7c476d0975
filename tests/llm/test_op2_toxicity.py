import random
import zlib

import numpy as np
import pytest

from quire.llm import op2_toxicity as op


def distances(a, b):
    """Edit distance of a to each prefix of b."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row


def test_automaton_equals_edit_distance():
    lexicon = op.Lexicon(["idiot", "moron", "worthless", "scum"], ["lowei", "vequ"], ["idiom"])
    rng = random.Random(0)
    for _ in range(20_000):
        w = list(rng.choice(sorted(lexicon.words | lexicon.stems)) + rng.choice(["", "", "x", "ab"]))
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(w) + 1)
            w[i:i + rng.randrange(2)] = rng.choice(["", "i", "d", "o", "w"])
        w = "".join(w)
        if w in lexicon.words:
            expected = op.WORD
        elif any(w.startswith(s) for s in lexicon.stems):
            expected = op.STEM
        elif w != "idiom" and (any(len(t) >= 5 and distances(t, w)[-1] <= 1 for t in lexicon.words)
                               or any(len(s) >= 5 and min(distances(s, w)) <= 1 for s in lexicon.stems)):
            expected = op.FUZZY
        else:
            expected = op.NONE
        assert lexicon.kind(w) == expected, w


def test_quotations_and_direct_words():
    counter = op.Counter(op.Lexicon(["idiot"], []))
    assert counter.counts("you are an Idiot, really") == (1, 0, 0, 0, 5)
    assert counter.counts('they wrote "you are an idiot" on the wall') == (0, 0, 0, 1, 9)
    assert counter.counts("the word idiot comes from Greek") == (0, 0, 0, 1, 6)
    assert counter.counts("what an idi0t and idiiot and idot") == (0, 0, 3, 0, 7)
    assert counter.counts("") == (0, 0, 0, 0, 0)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 6 == 0
        w = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 9))) for _ in range(40)]
        if toxic:
            for _ in range(3):
                w[rng.randrange(40)] = rng.choice(["grobnak", "vilsnort", "Grobnak!", "zwurp" + rng.choice(["ta", "lo", "mi", "ke"]), "grobnok"])
        rows.append((i, " ".join(w), "en", "s", 0.5))
        labels.append((i, 1, int(toxic)))
    labels += [(1, 1, 0), (9999, 1, 1), (None, 1, 1), (7, 1, None)]
    return (spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, score double"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    rows = op.toxicity(docs, labels).collect()
    assert len(rows) == 1200
    hits = [(r.predicted, r.doc_id % 6 == 0) for r in rows if r.held_out]
    assert len(hits) > 200
    assert np.mean([p == t for p, t in hits]) > 0.98
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_scores_depend_on_the_text_alone(spark, corpus):
    docs, labels = corpus
    a = {r.doc_id: r.score for r in op.toxicity(docs, labels).collect()}
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    assert {r.doc_id: r.score for r in op.toxicity(docs, flipped).collect()} == a
    moved = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'yy' AS source")
    assert {r.doc_id: r.score for r in op.toxicity(moved, labels).collect()} == a


def test_odd_inputs(spark, corpus, clashing, no_docs):
    _, labels = corpus
    none = labels.limit(0)
    rows = op.toxicity(clashing, labels).collect()
    assert len(rows) == clashing.count()
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert {r.score for r in op.toxicity(clashing, none).collect()} == {0.5}
    assert op.toxicity(no_docs, labels).count() == 0
    assert op.toxicity(no_docs, none).count() == 0
    empty = spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id bigint, text string")
    assert len({r.score for r in op.toxicity(empty, labels).collect()}) == 1


@pytest.fixture(scope="module")
def quoting(spark):
    """Abuse said to the reader, the same words quoted by clean texts, and abuse that is always misspelled."""
    rng = random.Random(4)

    def filler(n):
        return ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 9))) for _ in range(n)]

    rows, labels = [], []
    for i in range(1600):
        kind = ["direct", "misspelled", "quoted", "clean", "clean", "clean", "clean", "clean"][i % 8] if i % 16 < 8 else "clean"
        w = filler(30)
        for _ in range(3):
            word = rng.choice(["grobnak", "vilsnort", "plodwick"])
            at = rng.randrange(2, len(w) - 2)
            if kind == "direct":
                w[at] = word
            elif kind == "misspelled":
                k, letter = rng.randrange(2, 4), rng.choice("0123456789äöüéèàñçß")   # no stem of the word is left
                w[at] = rng.choice([word[:k] + letter + word[k:], word[:k] + letter + word[k + 1:]])
            elif kind == "quoted" and i % 32 < 8:
                w[at:at] = ["they", "wrote", f'"{word}"', "there"]
        rows.append((i, " ".join(w)))
        labels.append((i, int(kind in ("direct", "misspelled"))))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def measured(docs, labels):
    """Precision and recall of the held-out documents."""
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [(r.predicted, toxic[r.doc_id]) for r in op.toxicity(docs, labels).collect() if r.held_out]
    both = sum(p and t for p, t in rows)
    return both / max(1, sum(p for p, _ in rows)), both / max(1, sum(t for _, t in rows))


def test_quotations_raise_precision_and_misspellings_recall(quoting, monkeypatch):
    precision, recall = measured(*quoting)
    assert precision > 0.95 and recall > 0.85, (precision, recall)
    with monkeypatch.context() as m:
        m.setattr(op, "quoted", lambda words, i: False)
        blind, _ = measured(*quoting)
    with monkeypatch.context() as m:
        m.setattr(op.Lexicon, "near", lambda self, word: False)
        _, exact = measured(*quoting)
    assert blind < precision - 0.02 and exact < recall - 0.2, (precision, recall, blind, exact)
