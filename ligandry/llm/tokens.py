"""Exact byte-level BPE encoding of whole texts, with a bounded cache of the units between spaces.

A byte-level pre-tokeniser always cuts where a white-space run begins, so a text whose runs are single blanks or line
feeds is the concatenation of units ("word", " word", "\\nword") whose ids don't depend on their neighbours. Each unit is
encoded once per worker by the tokenizers library. Any other text, and any tokenizer set up otherwise, is encoded whole.
"""

from __future__ import annotations

import json
import os
import sys
from array import array

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
TOKENIZER = "byte_bpe_50k.json"
#: Units remembered by a worker, at about 200 bytes each.
CACHE = 400_000
_OTHER_SPACE = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace() and c not in " \n"]
_MARKS = "!#$%&*,.:;?"
_STABLE = "\u0500"  # below it Unicode's letters have long been settled, so isalpha() agrees with the tokenizer's own tables
_encoders: dict[str, "Encoder"] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level BPE writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Units(dict):
    """Ids of each unit, as bytes; at most CACHE units are remembered."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        got = self[unit] = self.encode(unit)
        return got


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.units = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer") and not spec.get("post_processor") and not spec.get("truncation") and not spec.get("padding")
        self.added = [x["content"] for x in spec.get("added_tokens", [])]
        self.letters, self.model = _byte_letters(), self.whole.model
        self.found = _Units(self._unit)  # units as they stand
        self.after_blank = _Units(lambda word: self._unit(word if word[:1] == "\n" else " " + word))

    def _direct(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def _unit(self, unit: str) -> bytes:
        word = unit[1:] if unit[:1] == " " else unit
        if not word or not (word.isascii() or max(word) < _STABLE):
            return array("I", self._direct(unit)).tobytes()
        if word.isalpha():  # one pre-token: straight to the merges
            if word.isascii():
                letters = unit if unit is word else self.letters[32] + word
            else:
                letters = unit.encode().decode("latin-1").translate(self.letters)
            return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        if word[0] == "\n" and len(word) > 1 and word[1] not in " \n":
            return self.found["\n"] + self.found[word[1:]]
        letters = word.rstrip(_MARKS)
        if letters.isalpha():  # letters, then marks: two pre-tokens
            n = len(letters) - len(word)
            return (self.after_blank[unit[1:n]] if unit[0] == " " else self.found[unit[:n]]) + self.found[unit[n:]]
        return array("I", self._direct(unit)).tobytes()

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        plain = self.units and not (text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text)
        if not plain or any(c in text for c in _OTHER_SPACE) or any(x in text for x in self.added):
            return np.array(self._direct(text), np.uint32)
        first, *parts = text.replace("\n", " \n").split(" ")  # a part that starts no line had a blank before it
        return np.frombuffer(self.found[first] + b"".join(map(self.after_blank.__getitem__, parts)), np.uint32)


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
