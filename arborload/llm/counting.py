"""Token counts by finite-state transducers.

Byte-level BPE is compiled into a cascade of two deterministic transducers.  The first
reads classes of characters and marks where a pre-token begins.  Texts are cut into
chunks of equal length, every chunk is run from all states at once, which gives its
state map, and a parallel prefix scan composes the maps, so that each chunk's entry
state is known.  The second reads the bytes of a pre-token; each transition carries
the change in the number of tokens.  All pre-tokens are run side by side.  Its states
are found as texts need them, since nearly all of them are never reached.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborload.llm.shared import require, ship, without
from arborload.llm.tokens import byte_letters

CHUNK = 64
BLOCK = 1 << 20
MOST_STATES = 1 << 18

# -- first transducer: where pre-tokens begin -----------------------------

_CLOSED, _LETTERS, _DIGITS, _OTHERS, _SPACE, _BLANKS, _QUOTE, _PAIR = range(8)
_L, _X, _D, _N, _O, _A, _SP, _W, _M, _Z = range(10)
#: Letters that end a contraction, and letters with the one that must follow (fixed values of the format).
_ENDINGS = "stmd"
_ENDING_PAIRS = ("re", "ve", "ll")
_BREAK = re.compile(r"(?<=\S)\s")


def _split_tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and boundary flag by symbol and state.

    Symbols: other letters, letters that end a contraction, letters that begin its
    two-letter end, digits, others, the apostrophe, a blank and another white space
    right before a word, any other white space, and the end of a text.
    """
    into = np.zeros((10, 8), dtype=np.uint8)
    cuts = np.ones((10, 8), dtype=bool)
    for symbol, state, joined in (
        (_L, _LETTERS, (_LETTERS, _SPACE)),
        (_X, _LETTERS, (_LETTERS, _SPACE)),
        (_D, _LETTERS, (_LETTERS, _SPACE)),
        (_N, _DIGITS, (_DIGITS, _SPACE)),
        (_O, _OTHERS, (_OTHERS, _SPACE, _QUOTE)),
        (_A, _OTHERS, (_OTHERS, _SPACE, _QUOTE)),
        (_SP, _SPACE, ()),
        (_W, _CLOSED, ()),
        (_M, _BLANKS, (_BLANKS,)),
        (_Z, _CLOSED, ()),
    ):
        into[symbol] = state
        cuts[symbol, list(joined)] = False
    into[_A, [_CLOSED, _LETTERS, _DIGITS, _BLANKS, _PAIR]] = _QUOTE
    into[_X, _QUOTE], into[_D, _QUOTE] = _CLOSED, _PAIR
    cuts[[_X, _D], _QUOTE] = False
    for symbol in (_L, _X, _D):
        into[symbol, _PAIR] = _CLOSED
        cuts[symbol, _PAIR] = False
    return into, cuts


_INTO, _CUTS = _split_tables()


def _classes() -> np.ndarray:
    """Symbol of every code point, before its neighbours are looked at."""
    table = np.full(0x110000, _O, dtype=np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind in "LN":
            table[code] = _L if kind == "L" else _N
    table[[*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _W
    table[0x20], table[ord("'")] = _SP, _A
    table[[ord(c) for c in _ENDINGS]] = _X
    return table


def symbols(codes: np.ndarray, ends: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Symbols of the code points of several texts; ``ends`` are the places after each."""
    found = classes[codes]
    found[ends] = _Z
    after = np.append(found[1:], np.uint8(_Z))
    blank = (found == _SP) | (found == _W)
    inside = blank & ((after == _SP) | (after == _W) | (after == _Z))
    for first, second in _ENDING_PAIRS:
        at = np.flatnonzero(codes == ord(first))
        at = at[at + 1 < len(codes)]
        at = at[(codes[at + 1] == ord(second)) & (found[at + 1] != _Z) & (found[at] != _Z)]
        found[at] = _D
    found[inside] = _M
    return found


def scan(maps: np.ndarray) -> np.ndarray:
    """Compose the state maps of all chunks up to and with each, by doubling steps."""
    total, step = maps.copy(), 1
    while step < len(total):
        later = np.take_along_axis(total[step:], total[:-step].astype(np.intp), axis=1)
        total[step:] = later
        step *= 2
    return total


def boundaries(found: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at each symbol."""
    size = -(-len(found) // CHUNK) * CHUNK
    padded = np.full(size, _Z, dtype=np.uint8)
    padded[: len(found)] = found
    lanes = np.ascontiguousarray(padded.reshape(-1, CHUNK).T)
    into, cuts = _INTO.ravel(), _CUTS.ravel()
    maps = np.tile(np.arange(8, dtype=np.uint8), (lanes.shape[1], 1))
    for row in lanes:
        maps = into[(row.astype(np.int16) * 8)[:, None] + maps]
    composed = scan(maps)
    state = np.concatenate(([np.uint8(_CLOSED)], composed[:-1, _CLOSED]))
    marks = np.empty_like(lanes, dtype=bool)
    for j, row in enumerate(lanes):
        at = row.astype(np.int16) * 8 + state
        marks[j] = cuts[at]
        state = into[at]
    return marks.T.ravel()[: len(found)]


# -- second transducer: tokens of a pre-token -----------------------------


class Compiler:
    """Transitions over bytes, annotated with the change in the number of tokens.

    After every byte BPE has a last token, and the tokens before it are those of the
    text before it.  A state is that token together with every longer beginning of a
    token that the last bytes make up, each with the token before it and the count up
    to there.  The next byte's last token is the one that ends there and can stand
    behind the token before it.
    """

    def __init__(self, merges: list[tuple[bytes, bytes]]) -> None:
        self.ranks = {bytes([b]): b for b in range(256)}
        self.joined: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for left, right in merges:
            a, b = self.ranks[left], self.ranks[right]
            rank = self.ranks.setdefault(left + right, 256 + len(self.joined))
            self.joined[a, b] = rank
            self.parts.setdefault(rank, (a, b))
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for text, rank in self.ranks.items():
            node = 0
            for byte in text:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = self.children[node][byte]
            self.token[node] = rank
        self._spines: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        """Forget all states but the first."""
        self.states: list[tuple] = [(-1, ())]
        self.numbers = {self.states[0]: 0}
        self.table = np.zeros(256 * (MOST_STATES + (1 << 14)), dtype=np.int32)

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at one edge of a token's merge tree, each with its parent's rank."""
        if (token, side) not in self._spines:
            line, parent, own = [], float("inf"), token
            while True:
                line.append((own, parent))
                if own not in self.parts:
                    break
                parent, own = own, self.parts[own][side]
            self._spines[token, side] = line
        return self._spines[token, side]

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart when BPE is applied to their joined text.

        They don't if two tokens that meet at the border join before either is used up
        inside its own side; of equal merges the leftmost comes first.
        """
        key = (left, right)
        if key not in self._fits:
            self._fits[key] = not any(
                rank < parent_a and rank <= parent_b
                for a, parent_a in self._spine(left, 1)
                for b, parent_b in self._spine(right, 0)
                if (rank := self.joined.get((a, b))) is not None
            )
        return self._fits[key]

    def step(self, state: int, byte: int) -> int:
        """Transition as ``next state * 256 + change + 128``, entered into the table.

        No transition leads back to the first state, so 0 stands for one not yet found.
        """
        last, open_starts = self.states[state]
        token, change, grown = -1, 0, []
        for node, before, count in (*open_starts, (0, last, 0)):
            child = self.children[node].get(byte)
            if child is None:
                continue
            if token < 0 and self.token[child] >= 0 and (before < 0 or self.fits(before, self.token[child])):
                token, change = self.token[child], count + 1
            if self.children[child]:
                grown.append((child, before, count))
        key = (token, tuple((n, b, c - change) for n, b, c in grown))
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(key)
            if 256 * len(self.states) > len(self.table):
                self.table = np.concatenate((self.table, np.zeros(len(self.table), dtype=np.int32)))
        packed = self.numbers[key] * 256 + change + 128
        self.table[state * 256 + byte] = packed
        return packed

    def counts(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of every pre-token."""
        if len(self.states) > MOST_STATES:
            self.clear()  # bounds memory; what is needed again is found again
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        state, total = np.zeros(len(starts), dtype=np.int32), np.zeros(len(starts), dtype=np.int32)
        ordered = -lengths
        at, active = 0, len(starts)
        while True:
            active = int(np.searchsorted(ordered[:active], -at, side="left"))
            if active < 16:
                break
            key = state[:active] * 256 + data[starts[:active] + at]
            packed = self.table[key]
            missing = np.flatnonzero(packed == 0)
            if len(missing):
                for k in np.unique(key[missing]).tolist():
                    self.step(k >> 8, k & 255)
                packed = self.table[key]
            state[:active] = packed >> 8
            total[:active] += (packed & 255) - 128
            at += 1
        for i in range(active):
            total[i] += self._run(int(state[i]), data[starts[i] + at : starts[i] + lengths[i]].tobytes())
        result = np.empty(len(starts), dtype=np.int64)
        result[order] = total
        return result

    def _run(self, state: int, text: bytes) -> int:
        total = 0
        for byte in text:
            packed = int(self.table[state * 256 + byte])
            if not packed:
                packed = self.step(state, byte)
            state = packed >> 8
            total += (packed & 255) - 128
        return total


class Counter:
    """Counts tokens as the tokenizers library does for a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.compiler = Compiler([tuple(bytes(letters[c] for c in side) for side in pair) for pair in pairs])
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = special
        self.cut = re.compile("|".join(map(re.escape, special))) if special else None
        self.classes = _classes()

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of every text; special strings in it are one token and cut it."""
        totals = np.zeros(len(texts), dtype=np.int64)
        owners: list[int] = []
        pieces: list[str] = []
        size = 0
        for owner, text in enumerate(texts):
            for piece in self._pieces(text, totals, owner):
                owners.append(owner)
                pieces.append(piece)
                size += len(piece)
                if size >= BLOCK:
                    self._add(pieces, owners, totals)
                    owners, pieces, size = [], [], 0
        self._add(pieces, owners, totals)
        return totals.tolist()

    def _pieces(self, text: str, totals: np.ndarray, owner: int) -> Iterator[str]:
        """The text between special strings, long texts cut where a word has ended."""
        parts = [text]
        if any(s in text for s in self.special):
            parts = self.cut.split(text)
            totals[owner] += len(parts) - 1
        for part in parts:
            at = 0
            while len(part) - at > BLOCK:
                found = _BREAK.search(part, at + BLOCK)
                if found is None:
                    break
                yield part[at : found.start()]
                at = found.start()
            yield part[at:] if at else part

    def _add(self, pieces: list[str], owners: list[int], totals: np.ndarray) -> None:
        """Count pieces; each is followed by a character that marks its end."""
        if not pieces:
            return
        joined = "\0".join(pieces) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
        marks = np.flatnonzero(boundaries(symbols(codes, ends, self.classes)))
        widths = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        places = np.cumsum(widths) - widths
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        begin = places[marks]
        lengths = np.diff(np.append(begin, len(data)))
        owner = np.searchsorted(ends, marks, side="left")
        real = marks != ends[owner]
        found = self.compiler.counts(data, begin[real], lengths[real])
        np.add.at(totals, np.asarray(owners)[owner[real]], found)


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter of a tokenizer file, made once per worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def counted(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """Documents with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    Adds the columns in place of input columns so named.  A NULL or empty text has no
    bytes and no tokens.  Texts of any length are counted whole; those without any
    white space are held by one task.  Repeated rows are counted alike; an empty table
    gives an empty table.
    """
    require(docs, "text")
    ship(docs.sparkSession)
    added = ("n_bytes", "n_tokens", "over_limit")
    columns = without(docs, added)
    chosen = docs.select(*[F.col(f"`{c}`") for c in columns])
    at = columns.index("text")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(tokenizer)
        for batch in batches:
            tokens = model.counts([t or "" for t in batch.column(at).to_pylist()])
            arrays = [*batch.columns, pa.array(tokens, pa.int64()), pa.array([t > limit for t in tokens], pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "n_tokens", "over_limit"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields]
    rows = chosen.mapInArrow(measured, ", ".join([*fields, "n_tokens long", "over_limit boolean"]))
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return rows.withColumn("n_bytes", size).select(*columns, *added)
