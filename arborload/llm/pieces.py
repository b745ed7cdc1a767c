"""SentencePiece encoding and decoding: byte-pair merges in vectorised rounds.

The characters of a block of texts lie in one flat array, cut into words where no piece
of the vocabulary spans the cut.  Each round finds the best rank among the neighbouring
pairs of every word, merges its occurrences from the left, and closes the gaps, until no
pair is left.  Words that are done leave the arrays.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborload.llm.shared import require, ship, without

SPACE = "▁"
UNKNOWN = " ⁇ "
#: Rounds after which the words that are left are finished one merge at a time.
ROUNDS = 256
BLOCK = 1 << 20
_NONE = np.int32(2**31 - 1)


class PairTable:
    """Values of pairs of symbols in an open-addressed hash table, looked up all at once."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]) -> None:
        bits = max(4, (4 * max(1, len(pairs))).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, -1, dtype=np.int64)
        self.ranks = np.full((1 << bits) + 1, _NONE, dtype=np.int32)  # the last place is that of no pair
        self.merged = np.zeros((1 << bits) + 1, dtype=np.int32)
        for (left, right), value in pairs.items():
            key = left << 32 | right
            at = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> (64 - bits)
            while self._keys[at] != -1:
                at = (at + 1) & self._mask
            self._keys[at], self.ranks[at], self.merged[at] = key, *value

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of the pairs, -1 where there is none."""
        key = left.astype(np.int64) << 32 | right
        at = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)
        seen = self._keys[at]
        out = np.where(seen == key, at, -1).astype(np.int32)
        left_over = np.flatnonzero((seen != key) & (seen != -1))
        while len(left_over):
            at[left_over] = (at[left_over] + 1) & self._mask
            seen = self._keys[at[left_over]]
            hit = seen == key[left_over]
            out[left_over[hit]] = at[left_over[hit]]
            left_over = left_over[~hit & (seen != -1)]
        return out


class PieceModel:
    """A SentencePiece BPE model with byte fallback, identity normalisation and a leading space.

    Symbols are the ids of pieces; characters that no piece contains are one further
    symbol, which never merges.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        spec = ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        rules, training = spec.normalizer_spec, spec.trainer_spec
        kinds = ModelProto.SentencePiece
        odd = {kinds.USER_DEFINED, kinds.UNUSED}
        if (
            training.model_type != 2
            or not training.byte_fallback
            or rules.precompiled_charsmap
            or not rules.add_dummy_prefix
            or rules.remove_extra_whitespaces
            or not rules.escape_whitespaces
            or training.treat_whitespace_as_suffix
            or any(p.type in odd for p in spec.pieces)
        ):
            raise ValueError(f"{path} is not a plain BPE model with byte fallback")
        self.end = SentencePieceProcessor(model_file=path).eos_id()
        ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == kinds.NORMAL}
        scores = {p: spec.pieces[i].score for p, i in ids.items()}
        ranks = {s: r for r, s in enumerate(sorted({*scores.values()}, reverse=True))}
        self.unknown_symbol = len(spec.pieces)
        self.longest = max([2, *map(len, ids)])

        alphabet = {c for p in ids for c in p}
        extra = {c: self.unknown_symbol + 1 + i for i, c in enumerate(sorted(alphabet - ids.keys()))}
        self.symbols = np.full(0x110000, self.unknown_symbol, dtype=np.int64)
        for c in alphabet:
            self.symbols[ord(c)] = ids.get(c, extra.get(c))
        symbol = ids | extra
        pairs: dict[tuple[int, int], tuple[int, int]] = {}
        next_to: dict[tuple[int, int], tuple[int, int]] = {}
        self.unsafe = np.zeros(len(spec.pieces), dtype=bool)
        for piece, i in ids.items():
            rank = ranks[scores[piece]]
            for k in range(1, len(piece)):
                next_to[symbol[piece[k - 1]], symbol[piece[k]]] = (1, 1)
                left, right = piece[:k], piece[k:]
                if left in symbol and right in symbol:
                    pairs[symbol[left], symbol[right]] = (rank, i)
                    for half in (left, right):
                        if len(half) > 1 and ranks[scores[half]] >= rank:
                            self.unsafe[ids[half]] = True
        self.pairs, self.next_to = PairTable(pairs), PairTable(next_to)
        self.merges = pairs
        self.bytes = np.zeros(256, dtype=np.int64)
        surfaces = []
        for i, p in enumerate(spec.pieces):
            if p.type == kinds.BYTE:
                value = int(p.piece[3:5], 16)
                self.bytes[value] = i
                surfaces.append(bytes([value]))
            elif p.type == kinds.NORMAL:
                surfaces.append(p.piece.replace(SPACE, " ").encode())
            else:
                surfaces.append(UNKNOWN.encode() if p.type == kinds.UNKNOWN else b"")
        self._is_byte = np.array([p.type == kinds.BYTE for p in spec.pieces])
        self._is_control = np.array([p.type == kinds.CONTROL for p in spec.pieces])
        self._led = np.array([p.type == kinds.NORMAL and p.piece.startswith(SPACE) for p in spec.pieces])
        self._pool = np.frombuffer(b"".join(surfaces), dtype=np.uint8)
        self._sizes = np.array([len(s) for s in surfaces], dtype=np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes

    # -- encoding ----------------------------------------------------------

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, without begin or end."""
        out: list[np.ndarray] = []
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(text)
            size += len(text) + 1
            if size >= BLOCK:
                out += self._encode(held)
                held, size = [], 0
        return out + self._encode(held)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        full = [(SPACE + t).replace(" ", SPACE) if t else "" for t in texts]
        ends = np.cumsum([len(t) for t in full], dtype=np.int64)
        codes = np.frombuffer("".join(full).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        if not len(codes):
            return [np.empty(0, np.int64) for _ in texts]
        symbols = self.symbols[codes]
        cut = np.ones(len(codes), dtype=bool)  # a word begins here
        cut[1:] = self.next_to.find(symbols[:-1], symbols[1:]) < 0
        cut[ends[ends < len(codes)]] = True
        merged = self.merge(symbols, cut)
        place = np.flatnonzero(merged >= 0)
        ids = merged[place]
        lost = ids >= self.unknown_symbol
        if lost.any():
            ids, place = self._fall_back(ids, place, lost, codes)
        return np.split(ids, np.searchsorted(place, ends[:-1], side="left"))

    def _fall_back(self, ids, place, lost, codes) -> tuple[np.ndarray, np.ndarray]:
        """Symbols without a piece become one id for each of their bytes."""
        at = np.flatnonzero(lost)
        code = codes[place[at]]
        width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
        repeat = np.ones(len(ids), dtype=np.int64)
        repeat[at] = width
        text = "".join(map(chr, code.tolist())).encode("utf-8", "surrogatepass")
        raw = np.frombuffer(text, dtype=np.uint8)
        out = np.repeat(ids, repeat)
        out[np.repeat(lost, repeat)] = self.bytes[raw]
        return out, np.repeat(place, repeat)

    def merge(self, symbols: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Symbols after all merges at the place of their first character, -1 elsewhere."""
        done = np.full(len(symbols), -1, dtype=np.int64)
        symbols, place = symbols.astype(np.int32), np.arange(len(symbols), dtype=np.int32)
        pair = self._pairs(symbols, np.append(cut[1:], True))
        for _ in range(ROUNDS):
            # Words without a pair are done; the others move together.
            starts = np.flatnonzero(cut)
            rank = self.pairs.ranks[pair]
            least = np.minimum.reduceat(rank, starts) if len(starts) else rank[:0]
            sizes = np.diff(np.append(starts, len(symbols)))
            open_words = least < _NONE
            if not open_words.all():
                stays = np.repeat(open_words, sizes)
                ended = np.flatnonzero(~stays)
                done[place[ended]] = symbols[ended]
                kept = np.flatnonzero(stays)
                if not len(kept):
                    return done
                symbols, place, cut, pair, rank = (a.take(kept) for a in (symbols, place, cut, pair, rank))
                least, sizes = least[open_words], sizes[open_words]
            found = np.flatnonzero(rank == np.repeat(least, sizes))
            found = found[self._first(found, pair[found], cut)]
            symbols[found] = self.pairs.merged[pair[found]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[found + 1] = False
            kept = np.flatnonzero(keep)
            symbols, place, cut, pair = (a.take(kept) for a in (symbols, place, cut, pair))
            # New pairs: each merged symbol with the next one, and the one before with it.
            moved = found - np.arange(len(found))
            ends = np.append(cut[1:], True)
            pair[moved] = self._pairs_at(symbols, ends, moved)
            before = moved[moved > 0] - 1
            pair[before] = self._pairs_at(symbols, ends, before)
        for start, end in self._bounds(cut):
            self._finish(symbols[start:end], place[start:end], done)
        return done

    def _first(self, found: np.ndarray, pair: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Which of the occurrences merge at once.

        Of overlapping ones every second goes, from the left.  A piece that can become
        part of a piece of no worse rank does not commute with its own other occurrences
        nearby: of these only the first of each cluster merges now.
        """
        word = np.cumsum(cut)[found]
        gap = np.diff(found, prepend=-(1 << 40))
        new = np.diff(word, prepend=-1) != 0
        chain = np.flatnonzero(new | (gap != 1))
        run = np.arange(len(found)) - np.repeat(chain, np.diff(np.append(chain, len(found))))
        chosen = run % 2 == 0
        lead = new | (gap > 2 * self.longest + 2)
        careful = self.unsafe[self.pairs.merged[pair]]
        clusters = np.flatnonzero(lead)
        if careful.any():
            whole = np.logical_or.reduceat(careful, clusters)
            careful = np.repeat(whole, np.diff(np.append(clusters, len(found))))
        return np.where(careful, lead, chosen)

    def _pairs(self, symbols: np.ndarray, last: np.ndarray) -> np.ndarray:
        pair = np.full(len(symbols), -1, dtype=np.int32)
        pair[:-1] = self.pairs.find(symbols[:-1], symbols[1:])
        pair[last] = -1
        return pair

    def _pairs_at(self, symbols: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
        inner = ~last[at]
        out = np.full(len(at), -1, dtype=np.int32)
        out[inner] = self.pairs.find(symbols[at[inner]], symbols[at[inner] + 1])
        return out

    @staticmethod
    def _bounds(cut: np.ndarray) -> Iterator[tuple[int, int]]:
        starts = np.flatnonzero(cut)
        yield from zip(starts.tolist(), np.append(starts[1:], len(cut)).tolist())

    def _finish(self, symbols: np.ndarray, place: np.ndarray, done: np.ndarray) -> None:
        """The remaining merges of one word, best rank first, then the leftmost."""
        own = symbols.tolist()
        after = list(range(1, len(own) + 1))
        before = list(range(-1, len(own) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(own):
                value = self.merges.get((own[i], own[after[i]]))
                if value is not None:
                    heapq.heappush(heap, (value[0], i, own[i], own[after[i]]))

        for i in range(len(own)):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if own[i] != left or j >= len(own) or own[j] != right:
                continue
            own[i], own[j], after[i] = self.merges[left, right][1], -1, after[j]
            if after[i] < len(own):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        left = np.array(own, dtype=np.int64)
        done[place[left >= 0]] = left[left >= 0]

    # -- decoding ----------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids: the leading space goes, invalid bytes become U+FFFD.

        Control ids show nothing, but end a run of bytes.
        """
        shown = np.flatnonzero(~self._is_control[ids])
        if not len(shown):
            return ""
        sizes = self._sizes[ids]
        starts = self._starts[ids]
        first = shown[0]
        if self._led[ids[first]]:
            starts[first] += 1
            sizes[first] -= 1
        ends = np.cumsum(sizes)
        spread = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        raw = self._pool[spread]
        single = self._is_byte[ids]
        if not single.any():
            return raw.tobytes().decode()
        edge = np.flatnonzero(np.diff(single.astype(np.int8))) + 1
        stops = [0, *ends[edge - 1].tolist(), len(raw)]
        kinds = single[np.concatenate(([0], edge))].tolist()
        parts = [raw[a:b].tobytes() for a, b in zip(stops, stops[1:])]
        return "".join(decoded_bytes(p) if k else p.decode() for p, k in zip(parts, kinds))


def decoded_bytes(data: bytes) -> str:
    """UTF-8 text; each byte that begins no character becomes U+FFFD on its own."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of a file, made once per worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encoded(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Documents with ``ids`` (an end id last) and ``decoded``, the text read back from them.

    The columns replace input columns so named, whatever their case.  A NULL or empty
    text has the end id alone and decodes to an empty text.  Whole texts are encoded,
    a block of about a million characters at a time; repeated rows are encoded alike and
    an empty table gives an empty table.  Spaces lost by the model's own rules stay
    lost: U+2581 in a text decodes to a space, as in the library.
    """
    require(docs, text)
    ship(docs.sparkSession)
    columns = without(docs, ("ids", "decoded"))
    chosen = docs.select(*[F.col(f"`{c}`") for c in columns])
    at = columns.index(text)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            found = [np.append(i, pieces.end) for i in pieces.encode([t or "" for t in batch.column(at).to_pylist()])]
            offsets = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.int32)))
            arrays = [*batch.columns, ids, pa.array([pieces.decode(i) for i in found], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "ids", "decoded"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields]
    return chosen.mapInArrow(measured, ", ".join([*fields, "ids array<int>", "decoded string"]))


def digests(rows: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Number of ids, and SHA-256 of the ids and of the decoded text, computed by Spark."""
    return rows.select(
        doc_id,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
