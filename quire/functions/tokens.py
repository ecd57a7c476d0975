"""BLEU's and ROUGE's tokens as a task-side helper, and tokens as numbers.

The same tokens as ``quire.functions.text`` gives, at a fraction of its cost
on long texts.  Of the 13a rules, the first skips spaces, as they separate
tokens anyway.  The second and third split full stops and commas from what is
beside them unless digits are; as each match uses up two characters, a run of
such marks c1..ck behind p and before q comes out as single marks, but the last
one stays with a digit q if no match of the second rule took it: with k odd
behind a digit p, with k even behind any other.  So where no mark stands before
a digit, all are single.
"""

from __future__ import annotations

import re

import numpy as np

# The first 13a rule's characters without the space (fixed values).
_SYMBOL = re.compile(r"([\{-\~\[-\`!-\&\(-\+\:-\@\/])")
_MARKS = re.compile(r"[.,]+")
_MARK_DIGIT = re.compile(r"[.,][0-9]")
_DIGIT_DASH = re.compile(r"([0-9])(-)")
_WORD = re.compile(r"[a-z0-9]+")
_DIGITS = frozenset("0123456789")


def _split_marks(m: re.Match) -> str:
    text, (start, end) = m.string, m.span()
    marks, digit = m.group(), text[start - 1] in _DIGITS
    if text[end] in _DIGITS and (end - start) % 2 == digit:
        if digit and end - start == 1:
            return marks
        return f" {' '.join(marks)}"
    return f" {' '.join(marks)} "


def words_13a(text: str) -> list[str]:
    """Tokens of BLEU's 13a tokenizer."""
    text = text.replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    if "&" in text:
        text = text.replace("&quot;", '"').replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">")
    text = _SYMBOL.sub(r" \1 ", f" {text} ")
    if _MARK_DIGIT.search(text):
        text = _MARKS.sub(_split_marks, text)
    else:
        text = text.replace(".", " . ").replace(",", " , ")
    return (_DIGIT_DASH.sub(r"\1 \2 ", text) if "-" in text else text).split()


def words_rouge(text: str) -> list[str]:
    """Tokens of ROUGE's default tokenizer."""
    return _WORD.findall(text.lower())


def numbers(words: list[str]) -> np.ndarray:
    """64-bit hashes of words, equal for equal words within a process; two different ones share a hash with a chance of 1 in 10**19."""
    return np.fromiter(map(hash, words), np.int64, len(words))
