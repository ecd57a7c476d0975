"""Token ids of whole texts by a tokenizer file, as a task-side helper.

Byte-level BPE files are encoded by the tiktoken library, which takes less than
half the time of the tokenizers library for the same ids.  Its ranks are the
file's ids, so this holds only where merges come in the order of their ids,
and each token that ends a word is what its own letters merge to; both are
checked on loading.  A file that marks word ends (suffix) gets each word with a
zero byte behind it: the letters with the suffix have the lowest ids of all
pairs, so the last letter and the mark merge first.  Texts with a special
token's string, a zero byte or a capital sigma (whose lower case depends on
its place), and files of other kinds, go through the tokenizers library.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# How byte-level tokenizers cut texts that name no pattern of their own (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space as Unicode defines it, for patterns in a library that counts more to it (fixed values).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD_END = b"\0"
# A run of twice so many characters without a space goes through the tokenizers library, whose time grows less with its length.
LONG_RUN = 4096


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level tokenizers write bytes (fixed values): printable Latin-1 as it is, the others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def ranks_of(model: dict) -> dict[bytes, int] | None:
    """Bytes -> id of a byte-level BPE whose merges come in the order of their ids; None for others."""
    if model.get("type") != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
        return None
    letters, suffix, vocab = byte_letters(), model.get("end_of_word_suffix") or "", model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merged = [a + b for a, b in pairs]
    base = [*letters, *(x + suffix for x in letters if suffix)]
    if set(vocab) != {*base, *merged} or len(vocab) != len(base) + len(merged):
        return None
    ids = [vocab[t] for t in merged]
    if any(a >= b for a, b in zip(ids, ids[1:])) or ids and max(vocab[t] for t in base) > ids[0]:
        return None

    def in_bytes(token: str) -> bytes:
        word = token[:-len(suffix)] if suffix and token.endswith(suffix) and len(token) > len(suffix) else token
        return bytes(letters[x] for x in word) + (WORD_END if word is not token else b"")

    return {in_bytes(t): i for t, i in vocab.items()}


def _latin(category: str) -> str:
    """The Latin-1 characters of a Unicode category, escaped for a pattern's class."""
    return "".join(f"\\x{c:02x}" for c in range(256) if unicodedata.category(chr(c)).startswith(category))


def _long_run(text: str) -> bool:
    """Whether some block of ``LONG_RUN`` characters has neither a space nor a line end."""
    return any(" " not in block and "\n" not in block for i in range(0, len(text) - LONG_RUN + 1, LONG_RUN) if (block := text[i:i + LONG_RUN]))


class Encoder:
    """Ids of texts as the tokenizer's ``encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = self.latin_words = self.core = None
        self._load(json.loads(self.tokenizer.to_str()))

    def _load(self, file: dict) -> None:
        import regex
        import tiktoken

        pre, norm, suffix = file["pre_tokenizer"] or {}, file["normalizer"], file["model"].get("end_of_word_suffix") or ""
        steps = pre.get("pretokenizers", [])
        kinds = [(s.get("type"), s.get("pattern"), s.get("content")) for s in (norm or {}).get("normalizers", [])]
        plain = norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not suffix
        lower = (kinds == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)] and suffix
                 and [s.get("type") for s in steps] == ["Split", "ByteLevel"] and steps[0].get("behavior") == "Removed" and steps[0].get("invert")
                 and "Regex" in steps[0]["pattern"] and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space"))
        ranks = ranks_of(file["model"]) if plain or lower else None
        if ranks is None:
            return
        core = tiktoken.Encoding("file", pat_str=PATTERN if plain else r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        # A piece that is a token is taken whole there: the merges must come to the same.
        ends = [t for t in file["model"]["vocab"] if t.endswith(suffix) and len(t) > len(suffix)]
        if all(len(self.tokenizer.model.tokenize(t[:len(t) - len(suffix)])) == 1 for t in ends):
            self.core = core
            if lower:
                pattern = steps[0]["pattern"]["Regex"].replace(r"[^\s", f"[^{SPACE}")
                self.words = regex.compile(pattern).findall
                self.latin_words = re.compile(pattern.replace("[\\p{L}]", f"[{_latin('L')}]").replace("[\\p{N}]", f"[{_latin('N')}]").replace(
                    "\\p{L}", _latin("L")).replace("\\p{N}", _latin("N"))).findall

    def _words(self, text: str) -> list[str]:
        """The words of a text in lower case."""
        try:
            text.encode("latin-1")    # nothing to compose, and the standard library's patterns do
        except UnicodeEncodeError:
            return self.words(unicodedata.normalize("NFC", text).lower())
        return self.latin_words(text.lower())

    def _ids(self, text: str) -> np.ndarray | None:
        """Ids by the core; None where the text must go through the tokenizer."""
        if self.core is None or any(s in text for s in self.special) or _long_run(text):
            return None
        if self.words is not None:
            if "\0" in text or "Σ" in text:
                return None
            words = self._words(text)
            if not words:
                return np.zeros(0, np.uint32)
            text = "\0".join(words) + "\0"
        return np.array(self.core.encode_ordinary(text), np.uint32)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text as uint32."""
        out = [self._ids(t) for t in texts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(e.ids, np.uint32)
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file, kept between tasks.

    This package travels to workers by value, so its own module variables
    start anew in each task; the encoders hang on the tokenizers module.
    """
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_kept_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def chunks(texts: pa.Array, rows: int = 64, size: int = 1 << 21) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of slices of a string column of about ``rows`` rows or ``size`` characters; null is empty."""
    first, held, n = 0, [], 0
    for i in range(len(texts)):
        t = texts[i].as_py() or ""
        held.append(t)
        n += len(t)
        if len(held) == rows or n > size:
            yield first, held
            first, held, n = i + 1, [], 0
    if held:
        yield first, held
