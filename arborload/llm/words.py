"""Hashes of the words of a text, all at once."""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = bytes([*range(0x09, 0x0E), 0x20])


class WordHasher:
    """64-bit polynomial hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a text.

    The powers of the base are kept for blocks of a MiB; a longer text is taken block
    by block, cut between words, so memory follows the longest word.
    """

    def __init__(self, separators: bytes = SPACE) -> None:
        self._cuts = np.zeros(256, dtype=bool)
        self._cuts[list(separators)] = True
        self._up, self._down = self._powers(1 << 12)

    @staticmethod
    def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
        tables = []
        for factor in (_BASE, _INVERSE):
            steps = np.full(count, factor, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        return tables[0], tables[1]

    def hashes(self, data: bytes) -> np.ndarray:
        return self.prefixes(data, ())[:, 0]

    def prefixes(self, data: bytes, sizes: tuple[int, ...]) -> np.ndarray:
        """A row per word: the hash of the word and those of its first bytes, by ``sizes``."""
        if len(data) <= BLOCK:
            return self._block(data, sizes)
        found, at = [], 0
        while at < len(data):
            end = min(at + BLOCK, len(data))
            while end < len(data) and not self._cuts[data[end]]:
                end += 1
            found.append(self._block(data[at:end], sizes))
            at = end
        return np.concatenate(found)

    def _block(self, data: bytes, sizes: tuple[int, ...]) -> np.ndarray:
        if len(data) >= len(self._up):
            self._up, self._down = self._powers(2 * len(data) + 2)
        raw = np.frombuffer(data, dtype=np.uint8)
        edges = np.flatnonzero(np.diff(np.concatenate(([True], self._cuts[raw], [True]))))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self._up[: len(raw)], out=sums[1:])
        stops = [ends, *[np.minimum(ends, starts + size) for size in sizes]]
        return np.stack([(sums[stop] - sums[starts]) * self._down[starts] for stop in stops], axis=1)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that their low bits can be used as buckets."""
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values
