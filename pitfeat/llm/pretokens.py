"""Splitting a text as a byte-level BPE tokenizer file says, before any merge."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import regex

#: Fixed value: the split pattern of byte-level pre-tokenization.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same split for texts below U+0250, in the terms of the faster standard module.
_SPACE, _NUMBER = r"\t-\r \x85\xa0", r"0-9\xb2\xb3\xb9\xbc-\xbe"
_LETTER = r"[^\W\d_\xb2\xb3\xb9\xbc-\xbe]"
_LATIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?{_LETTER}+| ?[{_NUMBER}]+"
    rf"| ?(?:[^\w{_SPACE}]|_)+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")
_WIDE = regex.compile(SPLIT)
# code points up to here are classed alike by the regex module and the library
_BEYOND_SHARED = re.compile("[^\x00-՗]")


class Splitter:
    """Cuts a text at special strings, then into pre-tokens.

    ``pieces(text)`` yields (is_special, strings). Texts with letters whose
    class depends on the Unicode version are split by the library itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self._cut = re.compile("|".join(
            re.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None

    def sections(self, text: str):
        """Alternating plain sections and special strings; plain ones at even places."""
        if self._cut is None or not self._cut.search(text):
            return [text]
        out, at = [], 0
        for m in self._cut.finditer(text):
            out += [text[at:m.start()], m.group()]
            at = m.end()
        return [*out, text[at:]]

    def split(self, text: str) -> list[str]:
        if not _BEYOND_LATIN.search(text):
            return _LATIN.findall(text)
        if not _BEYOND_SHARED.search(text):
            return _WIDE.findall(text)
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in found]


@lru_cache(maxsize=4)
def splitter(path: str) -> Splitter:
    return Splitter(path)
