"""
and FIXTURES.md, used only to cross-check the Spark operators."""

from __future__ import annotations

import json
import math
import re
from collections import Counter

# 13a tokenizer rules (same fixed values as quire.functions.text, Python syntax).
_RULES = [
    (re.compile(r"([\{-\~\[-\` -\&\(-\+\:-\@\/])"), r" \1 "),
    (re.compile(r"([^0-9])([\.,])"), r"\1 \2 "),
    (re.compile(r"([\.,])([^0-9])"), r" \1 \2"),
    (re.compile(r"([0-9])(-)"), r"\1 \2 "),
]


def tok13a(line: str) -> list[str]:
    line = line.replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    if "&" in line:
        line = line.replace("&quot;", '"').replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">")
    line = f" {line} "
    for rx, repl in _RULES:
        line = rx.sub(repl, line)
    return line.split()


def tok_rouge(text: str) -> list[str]:
    text = re.sub(r"[^a-z0-9]+", " ", text.lower())
    return [t for t in re.split(r"\s+", text) if t and re.match(r"^[a-z0-9]+$", t)]


def ngrams(tokens, n):
    return Counter(tuple(tokens[i:i + n]) for i in range(len(tokens) - n + 1))


def bleu(preds: list[str], refs: list[str], order: int = 4) -> float:
    m = [0] * order
    t = [0] * order
    c = r = 0
    for p, ref in zip(preds, refs):
        pt, rt = tok13a(p), tok13a(ref)
        c += len(pt)
        r += len(rt)
        for n in range(1, order + 1):
            overlap = ngrams(pt, n) & ngrams(rt, n)
            m[n - 1] += sum(overlap.values())
            if len(pt) - n + 1 > 0:
                t[n - 1] += len(pt) - n + 1
    prec = [m[i] / t[i] if t[i] > 0 else 0.0 for i in range(order)]
    if min(prec) > 0:
        geo = math.exp(sum((1.0 / order) * math.log(p) for p in prec))
    else:
        geo = 0.0
    if c == 0:
        return 0.0
    ratio = c / r if r else float("inf")
    bp = 1.0 if ratio > 1.0 else math.exp(1 - 1.0 / ratio)
    return geo * bp


def _f(p, r):
    return 2 * p * r / (p + r) if p + r > 0 else 0.0


def rouge_n(pred: str, ref: str, n: int) -> float:
    pc, rc = ngrams(tok_rouge(pred), n), ngrams(tok_rouge(ref), n)
    hits = sum((pc & rc).values())
    p = hits / max(sum(pc.values()), 1)
    r = hits / max(sum(rc.values()), 1)
    return _f(p, r)


def lcs(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def rouge_l(pred: str, ref: str) -> float:
    pt, rt = tok_rouge(pred), tok_rouge(ref)
    if not pt or not rt:
        return 0.0
    k = lcs(pt, rt)
    return _f(k / len(pt), k / len(rt))


def validate(line: str):
    """Reason for one stripped, non-blank line, or None (our rule set, incl. 'bad type')."""
    try:
        rec = json.loads(line)
    except json.JSONDecodeError:
        return "JSON parse error"
    if not isinstance(rec, dict) or "question" not in rec:
        return "missing or empty 'question'"
    q = rec["question"]
    if not isinstance(q, str):
        return "bad type for 'question'"
    if not q.strip():
        return "missing or empty 'question'"
    if "answer" not in rec:
        return "missing or empty 'answer'"
    a = rec["answer"]
    if not isinstance(a, str):
        return "bad type for 'answer'"
    if not a.strip():
        return "missing or empty 'answer'"
    if len(q) < 5:
        return "question too short"
    if len(a) < 10:
        return "answer too short"
    return None


def p95(values):
    s = sorted(values)
    return s[int(0.95 * len(s))]


def lcs_len_dp(a, b):
    """Textbook dynamic programme for the longest common subsequence."""
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def expected_sizes(n, train_ratio=0.8, val_ratio=0.1):
    """Split sizes as the reference computes them."""
    n_train, n_val = int(n * train_ratio), int(n * val_ratio)
    return n_train, n_val, n - n_train - n_val


def expected_val_size(n, test_size=0.1):
    return math.ceil(test_size * n)
