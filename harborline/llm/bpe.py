"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Texts of a batch become one array of code point classes. Each class is a
transition function of a small automaton; functions are composed by table in a
blocked associative scan, which gives the automaton's state before every code
point and with it every boundary, without a regular expression. The slices
between boundaries are dictionary-encoded, merged once each with a cache, and
put together again by index. Token end offsets in bytes are kept, so a token
leads back to its place in the text.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

# States: a token is finished; in letters, digits, other signs, white space;
# after a space that joins what follows; one or two letters before a
# contraction's end.
DONE, IN_L, IN_N, IN_O, IN_W, JOIN, LAST1, LAST2 = range(8)
# Symbols: letter, digit, other, apostrophe of a two- or three-sign contraction,
# white space before more of it or the end, last space of a run, other last one.
L, N, O, Q2, Q3, W, Z_SPACE, Z_OTHER = range(8)
#: Code points that are White_Space.
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Code points to take at once; a longer text is taken alone.
CHUNK = 1 << 18
#: Pieces the cache holds before it is emptied.
CACHE = 300_000
#: Pieces of more bytes are merged one by one; the rank of a pair that is no word.
LONG, NONE = 100, 1 << 40


@lru_cache(1)
def _classes() -> np.ndarray:
    """L, N, O or W of every code point."""
    kind = {"L": L, "N": N}
    out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], O) for c in range(0x110000)), np.uint8, 0x110000)
    out[SPACES] = W
    return out


def _next_state(state: int, sym: int) -> tuple[int, bool]:
    """(state after the symbol, whether a token starts at it)."""
    fresh = {L: IN_L, N: IN_N, O: IN_O, Q2: LAST1, Q3: LAST2, W: IN_W, Z_SPACE: JOIN, Z_OTHER: DONE}
    if state == LAST2:
        return LAST1, False
    if state == LAST1:
        return DONE, False
    if state == JOIN:
        return {L: IN_L, N: IN_N}.get(sym, IN_O), False
    goes_on = (state, sym) in {(IN_L, L), (IN_N, N), (IN_W, W)} or state == IN_O and sym in (O, Q2, Q3)
    return (state, False) if goes_on else (fresh[sym], True)


@lru_cache(1)
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(functions, compose, start): all that compositions of symbols can give.

    Element 0 is the identity, 1 + s the symbol s inside a text, 9 + s the
    symbol s as a text's first. functions[f, state]; compose[f, g] is f, then
    g; start[s, state] tells whether a token starts.
    """
    symbol = [tuple(_next_state(q, s)[0] for q in range(8)) for s in range(8)]
    first = [(f[DONE],) * 8 for f in symbol]
    elements = [tuple(range(8)), *symbol, *first]
    index: dict[tuple, int] = {}
    slots = []
    for f in elements:  # two symbols may act alike; each keeps its own slot
        slots.append(f)
        index.setdefault(f, len(slots) - 1)
    at = 0
    while at < len(slots):
        for g in elements:
            h = tuple(g[q] for q in slots[at])
            if h not in index:
                index[h] = len(slots)
                slots.append(h)
        at += 1
    compose = np.array([[index[tuple(g[q] for q in f)] for g in slots] for f in slots],
        np.uint8 if len(slots) < 256 else np.uint16)
    start = np.array([[_next_state(q, s)[1] for q in range(8)] for s in range(8)])
    return np.array(slots, np.uint8), compose, start


def _scan(e: np.ndarray, compose: np.ndarray, width: int = 256) -> np.ndarray:
    """Inclusive prefix compositions, block by block, blocks in step."""
    n = len(e)
    if n <= width:
        out = e.copy()
        for i in range(1, n):
            out[i] = compose[out[i - 1], e[i]]
        return out
    blocks = -(-n // width)
    grid = np.zeros((blocks, width), e.dtype)
    grid.reshape(-1)[:n] = e
    grid = np.ascontiguousarray(grid.T)
    for t in range(1, width):
        grid[t] = compose[grid[t - 1], grid[t]]
    before = np.concatenate((np.zeros(1, e.dtype), _scan(grid[-1].copy(), compose, width)[:-1]))
    grid = compose[before[None, :], grid]
    return np.ascontiguousarray(grid.T).reshape(-1)[:n]


def boundaries(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a token starts; ``first`` is true at each text's first code point."""
    if not len(points):
        return np.zeros(0, bool)
    sym = _classes()[points]
    ends = np.append(first[1:], True)
    space = sym == W
    follows = np.append(space[1:], True) | ends
    sym[space & ~follows & (points == 0x20)] = Z_SPACE
    sym[space & ~follows & (points != 0x20)] = Z_OTHER
    quote = np.flatnonzero((points == 0x27) & ~ends)
    if len(quote):
        after = points[quote + 1]
        sym[quote[np.isin(after, [ord(c) for c in "stmd"])]] = Q2
        quote = quote[quote + 2 < len(points)]
        quote = quote[~ends[quote + 1]]
        pair = points[quote + 1] * 256 + np.minimum(points[quote + 2], 255)
        sym[quote[(points[quote + 1] < 128) & np.isin(pair, [ord(a) * 256 + ord(b) for a,
            b in ("re", "ve", "ll")])]] = Q3
    functions, compose, start = _monoid()
    element = sym + np.where(first, 9, 1).astype(np.uint8)
    before = np.concatenate((np.zeros(1, compose.dtype), _scan(element.astype(compose.dtype), compose)[:-1]))
    state = functions[before, DONE]
    return start[sym, state] | first


class Vocabulary:
    """Ranks of byte strings, with a cache of merged pieces."""

    def __init__(self, lines: bytes):
        pairs = (line.split() for line in lines.splitlines() if line)
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.cache: dict[bytes, bytes] = {}
        size = max(self.ranks.values()) + 1
        words = [b""] * size
        for word, rank in self.ranks.items():
            words[rank] = word
        self.single = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        known = self.ranks
        joins = [
            (a << 32 | b, rank)
            for word, rank in known.items()
            for i in range(1, len(word))
            if (a := known.get(word[:i])) is not None and (b := known.get(word[i:])) is not None
        ]
        joins.sort()
        self.pair_keys = np.fromiter((k for k, _ in joins), np.int64, len(joins))
        self.pair_ranks = np.fromiter((r for _, r in joins), np.int64, len(joins))
        self.words = pa.array(words, pa.large_binary())
        self.length = np.fromiter(map(len, words), np.int64, size)

    def pieces(self, unique: list[bytes]) -> list[bytes]:
        """Ids of each piece, as the bytes of 32-bit numbers."""
        cache = self.cache
        if len(cache) > CACHE:
            cache.clear()
        out = [cache.get(p) for p in unique]
        new = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(new, self.merge([unique[i] for i in new]), strict=True):
            out[i] = ids
            if len(unique[i]) <= 256:
                cache[unique[i]] = ids
        return out

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Merge in each piece the adjacent pair of least rank, leftmost first, until none has a rank.

        A piece that is a word of the vocabulary stays whole. All others take
        one step a round together; those that are done leave the arrays.
        """
        out: list[bytes | None] = [None] * len(pieces)
        todo = []
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = np.int32(whole).tobytes()
            elif len(p) > LONG:
                out[i] = np.array(self._merge_long(p), np.int32).tobytes()
            else:
                todo.append(i)
        size = np.fromiter((len(pieces[i]) for i in todo), np.int64, len(todo))
        ids = self.single[np.frombuffer(b"".join(pieces[i] for i in todo), np.uint8)]
        place = np.array(todo, np.int64)
        while len(place):
            start = np.cumsum(size) - size
            last = np.zeros(len(ids), bool)
            last[start + size - 1] = True
            rank = self._pairs(ids[:-1], ids[1:])
            rank[last[:-1]] = NONE
            rank = np.append(rank, NONE)
            while True:
                step = np.minimum.reduceat(rank << 8 | np.arange(len(ids)) - np.repeat(start, size), start)
                done = step >> 8 == NONE
                if done.any():
                    break
                at = start + (step & 255)
                ids[at] = step >> 8
                keep = np.ones(len(ids), bool)
                keep[at + 1] = False
                ids, last = ids[keep], last[np.append(keep[1:], True)]
                rank = rank[keep]
                size = size - 1
                start = np.cumsum(size) - size
                at = at - np.arange(len(at))
                after, before = at[~last[at]], at[at > start]
                rank[at] = NONE
                rank[after] = self._pairs(ids[after], ids[after + 1])
                before = before - 1
                rank[before] = self._pairs(ids[before], ids[before + 1])
            text = ids.astype(np.int32).tobytes()
            for i, a, n in zip(place[done].tolist(), start[done].tolist(), size[done].tolist(), strict=True):
                out[i] = text[4 * a : 4 * (a + n)]
            ids = ids[np.repeat(~done, size)]
            place, size = place[~done], size[~done]
        return out

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each two joined words, NONE if they are no word."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap and links, for pieces of any length."""
        ranks, n = self.ranks, len(piece)
        end, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            alive[j], end[i] = False, stop
            if stop < n:
                prev[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := prev[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tokens of each text, ids, lengths in bytes) of all texts together."""
        chars = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        data = joined.encode("utf-8", "surrogatepass")
        first = np.zeros(len(points), bool)
        first[(np.cumsum(chars) - chars)[chars > 0]] = True
        at = np.flatnonzero(boundaries(points, first))
        if not len(at):
            return np.zeros(len(texts), np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)
        width = (1 + (points > 0x7F).astype(np.uint8) + (points > 0x7FF) + (points > 0xFFFF)).astype(np.int64)
        byte = np.cumsum(width) - width
        offsets = np.append(byte[at], len(data)).astype(np.int64)
        slices = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = slices.dictionary_encode()
        which = coded.indices.to_numpy()
        unique = self.pieces(coded.dictionary.to_pylist())
        n = np.fromiter(map(len, unique), np.int64, len(unique)) // 4
        flat = np.frombuffer(b"".join(unique), np.int32)
        lead, count = np.cumsum(n) - n, n[which]
        ids = flat[np.repeat(lead[which] - np.cumsum(count) + count, count) + np.arange(count.sum())]
        text_of = np.searchsorted(np.cumsum(chars), at, "right")
        return np.bincount(text_of, count, len(texts)).astype(np.int64), ids, self.length[ids]

    def decode(self, ids: np.ndarray, tokens: np.ndarray) -> pa.Array:
        """Bytes of each run of ``tokens`` ids."""
        if not len(ids):
            return pa.array([b""] * len(tokens), pa.binary())
        taken = self.words.take(pa.array(ids))
        ends = np.concatenate(([0], np.cumsum(self.length[ids])))
        offsets = ends[np.concatenate(([0], np.cumsum(tokens)))]
        return pa.Array.from_buffers(pa.large_binary(), len(tokens), [None, pa.py_buffer(offsets), taken.buffers()[2]])


_loaded: dict[int, Vocabulary] = {}


def _vocabulary(lines: bytes) -> Vocabulary:
    """The parsed file, once a worker."""
    key = hash(lines)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(lines)
    return _loaded[key]


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32)))


_ENCODED = ["id", "token_ids", "token_ends"]


def _encode_batches(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    for b in batches:
        chars = pc.utf8_length(b.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
        at = 0
        while at < b.num_rows:
            to, size = at + 1, int(chars[at])
            while to < b.num_rows and size + chars[to] <= CHUNK:
                size += int(chars[to])
                to += 1
            n, ids, length = vocabulary.encode([t or "" for t in b.column(1).slice(at, to - at).to_pylist()])
            offsets = np.concatenate(([0], np.cumsum(n)))
            total = np.cumsum(length)
            ends = total - np.repeat(np.concatenate(([0], total))[offsets[:-1]], n)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(at, to - at), _lists(offsets, ids),
                _lists(offsets, ends)], _ENCODED)
            at = to


def _decode_batches(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column(1)
        offsets = lists.offsets.to_numpy()
        ids = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
        decoded = vocabulary.decode(ids, np.diff(offsets)).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([*b.columns[:3], decoded], [*_ENCODED, "decoded"])


def _apply(rows: DataFrame, ranks_path: str, steps: list, extra: str = "") -> DataFrame:
    """``steps`` one after the other over the batches of a task, in one Python worker."""
    prepare(rows.sparkSession)
    with open(ranks_path, "rb") as f:
        ranks = rows.sparkSession.sparkContext.broadcast(f.read())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(ranks.value)
        for step in steps:
            batches = step(batches, vocabulary)
        yield from batches

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(each, f"id {kind}, token_ids array<int>, token_ends array<int>{extra}")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token_ids, token_ends): one row for each row of ``docs``.

    ``token_ends`` are the byte offsets at which tokens end. The file of ranks
    (``base64 rank`` a line) is read by the driver and broadcast; its size is
    that of the vocabulary. Null or empty text has no tokens; repeated rows and
    null ids stay as they are; an empty table gives an empty table. A batch
    holds about a quarter of a million code points, or one longer text.
    """
    return _apply(_rows(docs, id_col, text_col), ranks_path, [_encode_batches])


def decode(tokens: DataFrame, ranks_path: str) -> DataFrame:
    """``tokens`` of ``encode`` with ``decoded``, the bytes that the ids stand for."""
    return _apply(tokens.select(*_ENCODED), ranks_path, [_decode_batches], ", decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` without a second Python worker for each task."""
    return _apply(_rows(docs, id_col, text_col), ranks_path, [_encode_batches, _decode_batches], ", decoded binary")
