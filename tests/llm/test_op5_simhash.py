import random
import re

import numpy as np
import xxhash

from quire.llm import op5_simhash as op
from quire.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_groups(pairs):
    """pairs: [(id, fp)]; smallest id reachable over links of two bits or fewer."""
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(pairs):
        for j in range(i):
            if bin(a ^ pairs[j][1]).count("1") <= 2:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return [least.get(find(i)) for i in range(len(pairs))]


def test_groups_match_brute_force(odd_docs, odd_rows):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op.simhash_groups(odd_docs).collect()}
    pairs = [(r[0], brute_fingerprint(r[1])) for r in odd_rows]
    expected = {d: (f"{f:016x}", c) for (d, f), c in zip(pairs, brute_groups(pairs), strict=True)}
    assert got == expected
    assert got[200][0] == got[201][0] == got[202][0] == "0" * 16
    assert got[200][1] == got[201][1] == got[202][1]


def test_linked_fingerprints_of_every_kind(spark):
    rng = random.Random(1)
    fps = set()
    for _ in range(60):
        f = rng.getrandbits(64)
        fps.add(f)
        for _ in range(rng.randrange(6)):
            for _ in range(rng.randrange(1, 4)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    centre = rng.getrandbits(64)  # a group too large to compare directly
    fps |= {centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(1, 64, 5)}
    fps = sorted(fps)
    rows = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp bigint")
    found = {int(np.int64(r.node).view(np.uint64)): r.component for r in components(op.links(rows)).collect()}
    groups = brute_groups(list(enumerate(fps)))
    by_root = {}
    for f, g in zip(fps, groups, strict=True):
        by_root.setdefault(g, []).append(f)
    for members in by_root.values():
        assert len({found.get(f) for f in members}) == 1
        assert (members[0] in found) == (len(members) > 1)
    assert len({found[m[0]] for m in by_root.values() if len(m) > 1}) == sum(len(m) > 1 for m in by_root.values())


def test_large_group_equals_pairwise():
    rng = np.random.default_rng(0)
    base = np.uint64(0x0123456789ABCDEF)
    for bit in (0, 5, 32, 40):
        fp = np.unique(np.array([base ^ np.uint64((1 << int(rng.integers(64))) | (1 << int(rng.integers(64)))) for _ in range(300)]))
        low, high = fp & np.uint64(0xFFFFFFFF), fp >> np.uint64(32)
        segment = (low if bit < 32 else high) & np.uint64(~(1 << bit % 32) & 0xFFFFFFFF)
        members = fp[segment == segment[0]]
        found = op._large_group((bit << 32) | int(segment[0]), members.view(np.int64))
        for a, b in found:
            assert a != b
        # Every link lies within what two bits reach, step by step.
        reach = brute_groups(list(enumerate(int(x) for x in members)))
        at = {int(m): r for m, r in zip(members, reach, strict=True)}
        assert all(at[int(np.int64(a).view(np.uint64))] == at[int(np.int64(b).view(np.uint64))] for a, b in found)


def test_null_ids_repeats_and_empty(spark, clashing, no_docs):
    rows = op.simhash_groups(clashing).collect()
    assert len(rows) == clashing.count()
    assert all(r.component_id is not None for r in rows if r.doc_id is not None)
    assert op.simhash_groups(no_docs).count() == 0
    assert op.keep_one(no_docs).count() == 0
    only_null = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, "x y z")], "doc_id bigint, text string")
    assert {r.component_id for r in op.simhash_groups(only_null).collect()} == {None}
    assert op.keep_one(only_null).count() == 2


def test_keep_one_leaves_the_smallest_id(odd_docs, odd_rows, clashing):
    kept = sorted(r.doc_id for r in op.keep_one(odd_docs).collect())
    pairs = [(r[0], brute_fingerprint(r[1])) for r in odd_rows]
    assert kept == sorted(set(brute_groups(pairs)))
    assert op.keep_one(clashing).columns == clashing.columns
