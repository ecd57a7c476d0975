import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quire.llm import op13_divergence as op

SCHEMA = "text string, lang string, source string, value bigint, rank int, shard string"


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(rows, min_docs=10, top=10):
    """(lang, source, part, item, value, rank) of (text, lang, source) rows."""
    rows = [(terms(t), lang or "", source or "") for t, lang, source in rows]
    docs, groups, counts = defaultdict(Counter), defaultdict(set), defaultdict(Counter)
    for t, lang, source in rows:
        docs[lang].update(set(t))
        groups[lang].add(source)
        counts[lang, source].update(t)
    out = []
    for lang, sources in groups.items():
        kept = sorted((t for t, n in docs[lang].items() if n >= min_docs), key=str.encode)
        share = {}
        for s in sources:
            total = sum(counts[lang, s][t] for t in kept) + 2 * len(kept)
            share[s] = {t: 1 + 10**9 * (counts[lang, s][t] + 2) // total for t in kept}
        whole = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        q = {t: 1 + 10**9 * (n + 2) // (sum(whole.values()) + 2 * len(kept)) for t, n in whole.items()}
        for s in sources:
            p = share[s]
            pairs = [(o, sum((p[t] - share[o][t]) ** 2 // (p[t] + share[o][t]) for t in kept)) for o in sources if o != s]
            best = [(t, (p[t] - q[t]) ** 2 // (p[t] + q[t])) for t in kept if counts[lang, s][t] and p[t] > q[t]]
            for part, items in (("pair", pairs), ("term", best)):
                items.sort(key=lambda e: (-e[1], e[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


def made(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "clash") for r in rows], SCHEMA).repartition(4)


def run(df, **more):
    return sorted(tuple(r) for r in op.divergence(df, **more).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "abcdeéß" for b in "klmnop😀"]
    out = []
    for i in range(300):
        lang, source = rng.choice(["en", "de", "de", None, "xx"]), rng.choice(["hot", "hot", "s1", "s2", None, "éa"])
        out.append((" ".join(rng.choices(vocabulary, [1 + (hash_ * 7) % 11 for hash_ in range(len(vocabulary))], k=rng.randrange(30))).title(), lang, source))
    out += [(None, "en", "empty"), ("", "zz", "a"), ("1 2 - _", "zz", "b"), ("few words", "yy", "only"), ("Ab " * 60000 + "cd", "en", "long"), ("É éÉ", "en", "hot")]
    return out + out[:20]


@pytest.mark.parametrize("more", [{}, {"min_docs": 1, "top": 3}, {"min_docs": 2, "round_bytes": 1}])
def test_as_brute_force(spark, rows, more, monkeypatch):
    monkeypatch.setattr(op, "SHARD_KEYS", 12)
    monkeypatch.setattr(op, "BLOCK", 8)
    want = brute(rows, more.get("min_docs", 10), more.get("top", 10))
    assert run(made(spark, rows), **more) == want
    assert {r[2] for r in want} == {"pair", "term"} and any(r[0] == "zz" and r[4] == 0 for r in want)


def test_no_rows_and_no_terms(spark):
    assert run(made(spark, [])) == []
    assert run(made(spark, [("a", "en", "x"), (None, "en", "y"), ("b", None, None)])) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 100, 20_000])
def test_hash_is_minimal_and_perfect(n):
    keys = [b"key%d" % i for i in range(n)]
    seeds, by_slot, hashed = op.build_hash(keys)
    assert sorted(by_slot) == sorted(keys) and hashed == n
    shard = op.Shard(seeds.tobytes(), by_slot, hashed, 0)
    assert shard.find(by_slot, op._hashes(by_slot)).tolist() == list(range(n))
    others = [b"other%d" % i for i in range(1000)]
    assert (shard.find(others, op._hashes(others)) == -1).all()


def test_keys_with_equal_hashes(monkeypatch):
    monkeypatch.setattr(op, "_hashes", lambda keys: np.array([len(k) for k in keys], np.uint64))
    keys = [b"a", b"b", b"cc", b"dd", b"eee", b"f"]
    seeds, by_slot, hashed = op.build_hash(keys)
    assert sorted(by_slot) == sorted(keys) and hashed == 3
    shard = op.Shard(seeds.tobytes(), by_slot, hashed, 0)
    assert shard.find(by_slot, op._hashes(by_slot)).tolist() == list(range(6))
    assert shard.find([b"z"], op._hashes([b"z"])).tolist() == [-1]


def test_slots_are_handed_on_when_full(monkeypatch):
    monkeypatch.setattr(op, "SLOT_BYTES", 1)
    monkeypatch.setattr(op, "TEXT_CHARS", 1)
    import pyarrow as pa
    seeds, keys, hashed = op.build_hash([b"a", b"b", b"c"])

    class Sent:
        value = [("en", 1, 0, hashed, seeds.tobytes(), keys)]

    rows = [("en", "s", "a b a"), ("en", "t", "c x"), ("de", "s", "a"), ("en", "s", "A")]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["lang", "source", "text"])
    parts = list(op._counter(Sent)(iter([batch])))
    total = Counter()
    for part in parts:
        for r in part.to_pylist():
            total[r["source"], keys[r["slot"]]] += r["n"]
    assert total == {("s", b"a"): 3, ("s", b"b"): 1, ("t", b"c"): 1}


def test_shares_are_exact_for_large_counts():
    for count in (0, 1, 10**9, 10**13, 2 * 10**14):
        total = 2 * 10**14 + 12_345
        assert op._per_billion(np.array([count]), total)[0] == 1 + 10**9 * (count + 2) // total
