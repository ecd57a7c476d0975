"""Subword token counts of whole texts with a bounded table of pieces, as a task-side helper.

Byte-level tokenizers cut a text at white space before anything else: one
space goes with the word behind it, and a longer run gives all but its last
character a piece of their own.  So a text's count is the sum over pieces
between white space.  Corpora repeat pieces, so each is encoded once, with the
other new ones of its chunk of texts, and its count is kept in a table of two
generations.  When the young one is full it becomes the old one and the old
one goes; a piece found in the old one comes back into the young one, so
frequent pieces stay.  Other tokenizers, and texts that hold one of the
tokenizer's added tokens, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

MAX_PIECES = 400_000     # a generation; two take some 100 MB
MAX_PIECE_CHARS = 64     # longer pieces are rare and large, so they are not kept
CHUNK_CHARS = 1 << 21

# White space as Unicode defines it (fixed values).
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECE = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")


def cuts_at_spaces(file: dict) -> bool:
    """True for a tokenizer file whose byte-level steps cut at white space and change nothing across it."""
    pre, norm = file["pre_tokenizer"] or {}, file["normalizer"]
    if pre.get("type") == "ByteLevel":
        return norm is None and bool(pre.get("use_regex")) and not pre.get("add_prefix_space")
    steps, kinds = pre.get("pretokenizers", []), [s.get("type") for s in (norm or {}).get("normalizers", [])]
    return [s.get("type") for s in steps] == ["Split", "ByteLevel"] and kinds == ["NFC", "Replace", "Lowercase"] and not any(
        s.get("use_regex") or s.get("add_prefix_space") for s in steps)


class SubwordCounter:
    """Counts what ``Tokenizer.encode(text)`` gives, special tokens around the text included."""

    def __init__(self, path: str, max_pieces: int = MAX_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a Spark task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.around = self.tokenizer.num_special_tokens_to_add(False)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cuts = cuts_at_spaces(json.loads(self.tokenizer.to_str()))
        self.max_pieces, self.young, self.old = max_pieces, {}, {}

    def counts(self, texts: Iterable[str | None]) -> Iterator[int]:
        """Counts of texts in order; null counts as empty."""
        chunk, size = [], 0
        for text in texts:
            chunk.append(text or "")
            size += len(chunk[-1])
            if size > CHUNK_CHARS:
                yield from self._chunk(chunk)
                chunk, size = [], 0
        yield from self._chunk(chunk)

    def _whole(self, text: str) -> bool:
        return not self.cuts or any(a in text or a.lower() in text.lower() for a in self.added)

    def _encoded(self, texts: list[str], special: bool) -> Iterator[int]:
        return (len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=special))

    def _chunk(self, texts: list[str]) -> Iterator[int]:
        whole = [self._whole(t) for t in texts]
        pieces = [[] if w else _PIECE.findall(t) for w, t in zip(whole, texts)]
        new = set().union(*pieces) - self.young.keys()
        again = new & self.old.keys()
        self.young.update((p, self.old[p]) for p in again)
        fresh = list(new - again)
        self.young.update(zip(fresh, self._encoded(fresh, False)))
        encoded = self._encoded([t for w, t in zip(whole, texts) if w], True)
        get = self.young.__getitem__
        yield from [next(encoded) if w else self.around + sum(map(get, of)) for w, of in zip(whole, pieces)]
        for p in fresh:
            if len(p) > MAX_PIECE_CHARS:
                del self.young[p]
        if len(self.young) > self.max_pieces:
            self.young, self.old = {}, self.young
