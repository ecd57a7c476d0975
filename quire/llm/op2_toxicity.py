"""Toxicity scores: a learned lexicon, fuzzy matching, and context windows.

1. **Lexicon.**  From labelled documents, words and word stems (prefixes of 4
   to 8 letters) that toxic documents use far more often than others.  At most
   ``MAX_TERMS`` entries; they form a trie.
2. **Matching.**  A word is matched by intersecting the trie with the word's
   Levenshtein automaton, which accepts what is at most one edit away: the
   automaton's states are bit sets that step along the trie's letters, and a
   branch ends when no state is left.  Words go through it once and are kept in
   a bounded table.  Misspelled matches that clean training documents use are
   words of their own and do not count.
3. **Context.**  A window of ``WINDOW`` words around a match decides whether it is a
   quotation (inside quotation marks, or next to a reporting word) or direct;
   the two are counted apart.
4. **Score.**  Counts of direct exact words, stems and misspellings, and of
   quotations, go into a logistic regression fitted on the training documents.

Training uses at most ``MAX_TRAIN`` labelled documents, those of the smallest
id hashes.  Scores depend on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import SPACE_RUN, checkpointed, let

MAX_TRAIN = 40_000        # labelled documents used; their ids and labels are broadcast, under 1 MB
MAX_TERMS = 1_000         # lexicon entries, under 30 KB
MAX_KNOWN = 50_000        # clean words near the lexicon that are remembered
MIN_TOXIC = 5             # words an entry must stand behind in toxic documents
MIN_RATIO = 20.0          # times as frequent in toxic documents as in others
STEMS = (4, 8)            # letters of a stem
FUZZY_LETTERS = 5         # shorter entries match exactly only
WINDOW = 6
THRESHOLD = 0.3
MAX_WORDS = 300_000       # words a task remembers
TOP = 4                   # counts above are taken as this
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’‚‹›…¿¡–—"
OPENING, CLOSING = "\"“„«‘‚‹'", "\"”“»’‘›'"
REPORTING = frozenset("said says say wrote writes quote quoted quotes called calls calling word words term terms means insult slur "
                      "sagte sagt schrieb wort nannte dijo dice escribió palabra llamó dit écrit mot appelé".split())

NONE, WORD, STEM, FUZZY = 0, 1, 2, 3


class Lexicon:
    """A trie of words and stems, met by Levenshtein automata of one edit."""

    def __init__(self, words: list[str], stems: list[str], known: list[str] = ()):
        self.words, self.stems, self.known = frozenset(words), frozenset(stems), frozenset(known)
        self.root: dict = {}
        for kind, terms in ((WORD, words), (STEM, stems)):
            for term in terms:
                if len(term) >= FUZZY_LETTERS:
                    node = self.root
                    for letter in term:
                        node = node.setdefault(letter, {})
                    node[kind] = True
        # One edit leaves a term's first two letters as they are, or all behind them.
        fuzzy = [t for t in (*words, *stems) if len(t) >= FUZZY_LETTERS]
        self.heads = frozenset(t[:2] for t in fuzzy)
        self.middles = frozenset(t[2:5] for t in fuzzy)
        self.lengths = sorted({len(s) for s in stems})

    def kind(self, word: str) -> int:
        """WORD, STEM, FUZZY or NONE for a lower-case word."""
        if word in self.words:
            return WORD
        if any(word[:n] in self.stems for n in self.lengths):
            return STEM
        if len(word) < FUZZY_LETTERS - 1 or word in self.known:
            return NONE
        if word[:2] not in self.heads and self.middles.isdisjoint((word[1:4], word[2:5], word[3:6])):
            return NONE
        return FUZZY if self.near(word) else NONE

    def near(self, word: str) -> bool:
        """Whether a word of the trie, or a stem at the word's start, is at most one edit away."""
        letters: dict[str, int] = {}
        for i, letter in enumerate(word):
            letters[letter] = letters.get(letter, 0) | 1 << i
        end, limit = 1 << len(word), (2 << len(word)) - 1
        # Bit i of a state set: the automaton may be behind i letters of the word, after no edit or one.
        todo = [(self.root, 1, 0b10)]
        while todo:
            node, exact, edited = todo.pop()
            for letter, below in node.items():
                if letter in (WORD, STEM):
                    if letter == STEM or (exact | edited) & end:
                        return True
                    continue
                same = letters.get(letter, 0)
                now = (exact & same) << 1
                # A match behind an edit; a letter too few, changed, or too many in the word.
                after = (((edited & same) << 1) | exact | (exact << 1) | (now << 1)) & limit
                if now or after:
                    todo.append((below, now, after))
        return False


def normal(word: str) -> str:
    """A word as the lexicon holds it: without marks at its ends (``word`` is in lower case)."""
    return word.strip(EDGES)


class Counter:
    """Matches of a text by kind, direct ones and quotations apart."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.kinds = lexicon, {}

    def _kind(self, word: str) -> int:
        k = self.kinds.get(word)
        if k is None:
            if len(self.kinds) > MAX_WORDS:
                self.kinds.clear()
            k = self.kinds[word] = self.lexicon.kind(normal(word))
        return k

    def counts(self, text: str) -> tuple[int, int, int, int, int]:
        """(words, stems, misspellings, quotations, words in all); quotations of any kind."""
        words = text.lower().split()
        kinds = list(map(self._kind, words))
        out = [0, 0, 0, 0]
        if any(kinds):
            for i, k in enumerate(kinds):
                if k:
                    out[3 if quoted(words, i) else k - 1] += 1
        return (*out, len(words))


def quoted(words: list[str], i: int) -> bool:
    """Whether the window around word i shows a quotation: marks open before it and close behind it, or a reporting word."""
    before, behind = words[max(0, i - WINDOW):i + 1], words[i:i + WINDOW + 1]
    opened = False
    for w in before:
        opened = w[0] in OPENING or (opened and w[-1:] not in CLOSING) if w is not before[-1] else opened or w[0] in OPENING
    if opened and any(c in CLOSING for w in behind for c in w[-2:]):
        return True
    return any(normal(w) in REPORTING for w in (*before[-4:-1], *behind[1:4]))


# -- training ----------------------------------------------------------------------------

def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_set(labels: DataFrame, id_col: str, label_col: str, most: int = MAX_TRAIN) -> DataFrame:
    """``(_id, toxic)`` of at most ``most`` labelled documents that are not held out; a document labelled twice is toxic if either says so."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    one = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    return checkpointed(one.orderBy(F.xxhash64("_id"), "_id").limit(most))


def _words(text: Column) -> Column:
    """The words of a text in order, as ``normal`` gives them."""
    edge = "".join("\\" + c if c in r"\[]^-&" else c for c in EDGES)
    return F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE_RUN), lambda w: F.regexp_replace(w, f"^[{edge}]+|[{edge}]+$", ""))


def _support(toxic: DataFrame, text_col: str) -> DataFrame:
    """``(word, before)``: the distinct words that stand before a word in toxic documents.

    Copies and shared passages repeat a word behind the same word; a term that
    people use stands behind many.  So a term's support is counted in these,
    and not in documents, of which a third may be copies of one.
    """
    pairs = let(_words(F.col(text_col)), lambda words: F.transform(
        words, lambda w, i: F.struct(w.alias("word"), F.coalesce(F.get(words, i - 1), F.lit("")).alias("before"))))
    return checkpointed(toxic.select(F.inline(pairs)).where("word <> ''").distinct())


def word_table(train: DataFrame, support: DataFrame, text_col: str) -> DataFrame:
    """``(word, toxic, clean)``: a word's support in toxic documents, and the clean documents that hold it; checkpointed."""
    clean = train.where("toxic <= 0").select(F.explode(F.array_distinct(_words(F.col(text_col)))).alias("word")).where("word <> ''")
    rows = clean.groupBy("word").agg(F.lit(0).cast("long").alias("toxic"), F.count(F.lit(1)).alias("clean")).unionByName(
        support.groupBy("word").agg(F.count(F.lit(1)).alias("toxic"), F.lit(0).cast("long").alias("clean")))
    return checkpointed(rows.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def stem_table(support: DataFrame, table: DataFrame) -> DataFrame:
    """``(word, toxic, clean)`` of stems with several forms: their support, and an upper bound of the clean documents
    (those of their words, summed)."""
    low, high = STEMS

    def stems(rows: DataFrame, *more: str) -> DataFrame:
        lengths = F.explode(F.sequence(F.lit(low), F.least(F.lit(high), F.length("word")))).alias("n")
        return rows.where(F.length("word") >= low).select("word", lengths, *more).withColumn("stem", F.expr("substring(word, 1, n)"))

    toxic = stems(support, "before").groupBy("stem", "before").agg(F.count(F.lit(1))).groupBy("stem").agg(F.count(F.lit(1)).alias("toxic")).where(
        F.col("toxic") >= MIN_TOXIC)
    clean = stems(table, "clean").groupBy(F.col("stem").alias("word")).agg(F.sum("clean").alias("clean"), F.count(F.lit(1)).alias("forms"))
    return clean.where("forms > 1").join(toxic, F.col("word") == F.col("stem")).select("word", "toxic", "clean")


def learn_lexicon(table: DataFrame, stems: DataFrame, n_toxic: int, n_clean: int, most: int = MAX_TERMS) -> Lexicon:
    """The entries that are MIN_RATIO times as frequent in toxic documents, most frequent first."""
    ratio = (F.col("toxic") + 0.0) * (n_clean + 1) / ((F.col("clean") + 0.5) * (n_toxic + 1))
    strong = (F.col("toxic") >= MIN_TOXIC) & (ratio >= MIN_RATIO)

    def pick(rows: DataFrame) -> list[str]:
        return [r[0] for r in rows.where(strong).orderBy(F.col("toxic").desc(), "word").limit(most).collect()]

    kept: set[str] = set()
    for s in sorted(pick(stems), key=lambda s: (len(s), s)):  # a stem covers longer ones
        if not any(s[:n] in kept for n in range(STEMS[0], len(s))):
            kept.add(s)
    words = [w for w in pick(table) if not any(w[:n] in kept for n in range(STEMS[0], STEMS[1] + 1))]
    return Lexicon(words, sorted(kept))


def clean_neighbours(table: DataFrame, lexicon: Lexicon, most: int = MAX_KNOWN) -> list[str]:
    """Words of clean training documents that would match as misspellings, most frequent first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = pa.array([lexicon.kind(w.as_py()) == FUZZY for w in batch.column(0)])
            yield batch.filter(near)

    rows = table.where("clean > 0").select("word", "clean").mapInArrow(run, "word string, clean bigint")
    return [r[0] for r in rows.orderBy(F.col("clean").desc(), "word").limit(most).collect()]


def features(counts: np.ndarray) -> np.ndarray:
    """Rows of (words, stems, misspellings, quotations) to the regression's inputs."""
    c = np.minimum(counts, TOP).astype(float)
    return np.column_stack([np.ones(len(c)), np.log1p(c), c[:, :3].sum(axis=1) > 0])


def fit(counts: np.ndarray, toxic: np.ndarray, clean: np.ndarray, penalty: float = 0.05, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton's method on rows with numbers of toxic and clean documents."""
    x, n = features(counts), (toxic + clean).astype(float)
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (toxic - n * p) - penalty * beta
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        size = np.abs(step).max()
        beta += step * min(1.0, 2.0 / max(size, 1e-12))
        if size < 1e-9:
            break
    return beta


def count_matches(docs: DataFrame, lexicon: Lexicon, keep: list[str], text_col: str) -> DataFrame:
    """The columns ``keep`` plus ``n_words, n_stems, n_fuzzy, n_quoted, n_all`` (int)."""
    names = [*keep, "n_words", "n_stems", "n_fuzzy", "n_quoted", "n_all"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(lexicon)
        for batch in batches:
            rows = [counter.counts(t.as_py() or "") for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array([r[i] for r in rows], pa.int32()) for i in range(5)]], names)

    rows = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.drop("_text").schema)
    return rows.mapInArrow(run, schema + "n_words int, n_stems int, n_fuzzy int, n_quoted int, n_all int")


# -- operator ----------------------------------------------------------------------------

def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             max_train: int = MAX_TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """``(id_col, held_out, score, predicted, n_words, n_stems, n_fuzzy, n_quoted)`` per row of ``docs``.

    Null or empty text: the score of a text without matches.  A null id is
    not held out.  Repeated rows get equal results; in training each counts.
    Labels without a document, and null labels, are not used.  Without
    training documents of both kinds the lexicon is empty and every score is
    the smoothed share of toxic ones.  An empty table gives an empty result.
    """
    chosen = training_set(labels, id_col, label_col, max_train)
    train = checkpointed(docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(
        F.broadcast(chosen), "_id").select("toxic", "_text"))  # at most max_train rows are broadcast
    sizes = {r[0]: r[1] for r in train.groupBy(F.col("toxic") > 0).count().collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if n_toxic and n_clean:
        support = _support(train.where("toxic > 0"), "_text")
        table = word_table(train, support, "_text")
        lexicon = learn_lexicon(table, stem_table(support, table), n_toxic, n_clean)
        lexicon = Lexicon(list(lexicon.words), list(lexicon.stems), clean_neighbours(table, lexicon))
    else:
        lexicon = Lexicon([], [])
    names = ["n_words", "n_stems", "n_fuzzy", "n_quoted"]
    seen = count_matches(train, lexicon, ["toxic"], "_text").groupBy(
        *[F.least(F.col(c), F.lit(TOP)).alias(c) for c in names]).agg(
        F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") > 0, 0).otherwise(1)).alias("c")).collect()
    rows = np.array([[r[i] for i in range(6)] for r in seen] or [[0, 0, 0, 0, 1, 1]], float)
    beta = fit(rows[:, :4], rows[:, 4], rows[:, 5])
    counted = count_matches(docs, lexicon, [id_col], text_col)
    c = [F.least(F.col(n), F.lit(TOP)).cast("double") for n in names]
    logit = F.lit(float(beta[0]))
    for b, x in zip(beta[1:], [F.log1p(x) for x in c] + [F.when(c[0] + c[1] + c[2] > 0, 1.0).otherwise(0.0)], strict=True):
        logit = logit + F.lit(float(b)) * x
    score = 1 / (1 + F.exp(-logit))
    return counted.select(id_col, held_out(F.col(id_col)).alias("held_out"), score.alias("score"),
                          F.when(score >= threshold, 1).otherwise(0).cast("int").alias("predicted"), *names)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
