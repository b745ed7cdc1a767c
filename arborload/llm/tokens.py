"""Byte-level BPE of a public tokenizer file, as the tokenizers library applies it."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

#: The split of the byte-level pre-tokenizer (fixed value of the format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A run of white space that is encoded by the file's own library.
LONG_SPACE = 100_000
_LONG_SPACE = re.compile(rf"\s{{{LONG_SPACE}}}")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary.

    Printable bytes stand for themselves, the others follow from code point 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def description(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Token bytes with their ids, and the special strings with theirs."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = byte_letters()
    special = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
    vocabulary = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    return vocabulary, special


class Encoder:
    """Ids of whole texts.

    Special strings in a text become their own id and cut it, as is the library's
    default; no other special token is added.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        from tokenizers import Tokenizer

        vocabulary, self.special = description(path)
        self.whole = Tokenizer.from_file(path)
        self.plain = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        cut = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, cut)) + ")") if cut else None
        self.size = 1 + max([*vocabulary.values(), *self.special.values()])

    def ids(self, text: str) -> np.ndarray:
        if self.cut is None or not any(s in text for s in self.special):
            return self._ordinary(text)
        parts = [
            np.array([self.special[p]], dtype=np.uint32) if p in self.special else self._ordinary(p)
            for p in self.cut.split(text)
        ]
        return np.concatenate(parts)

    def _ordinary(self, text: str) -> np.ndarray:
        if len(text) > LONG_SPACE and _LONG_SPACE.search(text):
            # The other library's pattern runs out of stack on such a run.
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.plain.encode_to_numpy(text, allowed_special=set(), disallowed_special=())


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
