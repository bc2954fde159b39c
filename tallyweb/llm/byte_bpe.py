"""Byte-level BPE encoding and decoding.

Pre-tokenisation without regex: every code point becomes one of a few symbols (its class,
with what little lookahead the pattern needs), each symbol is a transition function on
eight states, and as composition of functions is associative, a blocked scan finds the
state before every code point, and from it the boundaries. The resulting slices are
dictionary-encoded; a bounded cache holds the ids of slices seen before, and the others are
merged together, a matrix of slices of one length at a time. Byte offsets of all tokens are
kept, and decoding gathers the vocabulary's bytes.

The symbols below spell out the public pre-tokenisation pattern
's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

No shuffle: one pass over the table, a step of about a megabyte of text at a time, so
memory does not depend on the partition; a single longer text is one step.

Defined cases: a null or empty text has no tokens (its hashes are those of no bytes);
bytes that are not UTF-8 are replaced by U+FFFD before encoding, as a decoder would;
repeated rows are encoded one by one; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweb.llm.common import steps

# States before a code point: in a letter, number, other or white-space run; after a space
# that joins what follows; with one or two letters of a contraction to come; at a token's end.
_L, _N, _O, _W, _A, _K1, _K2, _E = range(8)
# Symbols: letter, number, other, white space, space before a non-space, other white space
# before a non-space, apostrophe before s/t/m/d, apostrophe before re/ve/ll.
_S_L, _S_N, _S_O, _S_W, _S_SPACE, _S_LAST, _S_Q1, _S_Q2 = range(8)
#: Code points of White_Space.
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_BLOCK = 64
_LONG = 48
CACHE_SLICES = 150_000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """next[symbol, state], and fresh[symbol, state]: whether a token begins. Symbols 8-15: the same at a text's start."""
    after = np.zeros((16, 8), dtype=np.uint8)
    fresh = np.ones((16, 8), dtype=bool)
    plain = {_S_L: _L, _S_N: _N, _S_O: _O, _S_W: _W, _S_SPACE: _A, _S_LAST: _E, _S_Q1: _K1, _S_Q2: _K2}
    for symbol, state in plain.items():
        after[symbol] = after[symbol + 8] = state
    joins = {(_S_L, _L): _L, (_S_L, _A): _L, (_S_L, _K2): _K1, (_S_L, _K1): _E, (_S_N, _N): _N, (_S_N, _A): _N, (_S_W, _W): _W}
    joins |= {(q, s): _O for q in (_S_O, _S_Q1, _S_Q2) for s in (_O, _A)}
    for (symbol, state), then in joins.items():
        after[symbol, state], fresh[symbol, state] = then, False
    return after, fresh


_AFTER, _FRESH = _tables()


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """0 letter, 1 number, 2 other, 3 white space, by code point."""
    kind = {"L": 0, "N": 1}
    out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], 2) for c in range(0x110000)), dtype=np.uint8, count=0x110000)
    out[SPACES] = 3
    return out


def _symbols(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """points: code points of all texts; heads: where texts begin."""
    kind = _classes()[points]
    n = len(points)
    ends = np.zeros(n + 3, dtype=bool)  # a text begins here
    ends[heads] = True
    ends[n:] = True
    after = np.append(points, [0, 0, 0])
    out = kind.copy()
    solid = np.append(kind != 3, False) & ~ends[: n + 1]
    last = (kind == 3) & solid[1:]
    out[last] = np.where(points[last] == 0x20, _S_SPACE, _S_LAST)
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        one, two = after[quote + 1], after[quote + 2]
        has1, has2 = ~ends[quote + 1], ~ends[quote + 1] & ~ends[quote + 2]
        short = has1 & np.isin(one, [ord(c) for c in "stmd"])
        pair = has2 & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        out[quote[short]] = _S_Q1
        out[quote[pair]] = _S_Q2
    out[heads] += 8
    return out


def boundaries(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Positions in points where tokens begin."""
    n = len(points)
    if not n:
        return np.empty(0, dtype=np.int64)
    rows = -(-n // _BLOCK)
    symbols = np.zeros(rows * _BLOCK, dtype=np.uint8)
    symbols[:n] = _symbols(points, heads)
    columns = np.ascontiguousarray(symbols.reshape(rows, _BLOCK).T)
    # Up: the function of each block. A constant function is one too, so texts need no blocks of their own.
    whole = np.broadcast_to(np.arange(8, dtype=np.uint8), (rows, 8))
    flat = _AFTER.ravel()
    for j in range(_BLOCK):
        whole = flat[(columns[j][:, None].astype(np.intp) << 3) | whole]
    # Across: inclusive scan of the blocks' functions by doubling.
    scan, step = whole.copy(), 1
    while step < rows:
        scan[step:] = np.take_along_axis(scan[step:], scan[:-step].astype(np.intp), 1)
        step *= 2
    state = np.full(rows, _E, dtype=np.uint8)
    state[1:] = scan[:-1, _E]
    # Down: each block from the state that it starts in.
    fresh = np.empty((_BLOCK, rows), dtype=bool)
    starts = _FRESH.ravel()
    for j in range(_BLOCK):
        at = (columns[j].astype(np.intp) << 3) | state
        fresh[j] = starts[at]
        state = flat[at]
    return np.flatnonzero(np.ascontiguousarray(fresh.T).ravel()[:n])


class Tokenizer:
    """ranks: token bytes to id, as read from a public vocabulary file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = [(a << 32 | b, r) for t, r in self.ranks.items() if len(t) > 1 for k in range(1, len(t)) if (a := self.ranks.get(t[:k])) is not None and (b := self.ranks.get(t[k:])) is not None]
        self._levels = self._hashed(np.array([p for p, _ in pairs], dtype=np.int64), np.array([r for _, r in pairs], dtype=np.int64))
        self.none = np.int64(1 << 40)
        self.cache: dict[bytes, np.ndarray] = {}

    @staticmethod
    def _slot(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9][level % 3])
        return (mixed >> np.uint64(64 - bits)).astype(np.intp)

    def _hashed(self, keys: np.ndarray, values: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Hash tables; a pair that finds its slot taken goes to the next."""
        levels, bits = [], max(10, int(len(keys)).bit_length() + 1)
        while len(keys):
            held, found = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)
            slot = self._slot(keys, len(levels), bits)
            _, first = np.unique(slot, return_index=True)
            held[slot[first]], found[slot[first]] = keys[first], values[first]
            levels.append((bits, held, found))
            rest = np.ones(len(keys), dtype=bool)
            rest[first] = False
            keys, values = keys[rest], values[rest]
        return levels

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, none if there is no such token."""
        shape = left.shape
        keys = (left << 32 | right).ravel()
        out, at = np.full(len(keys), self.none), np.arange(len(keys))
        for level, (bits, held, found) in enumerate(self._levels):
            slot = self._slot(keys[at], level, bits)
            hit = held[slot] == keys[at]
            out[at[hit]] = found[slot[hit]]
            at = at[~hit & (held[slot] >= 0)]
            if not len(at):
                break
        return out.reshape(shape)

    def _merge_equal(self, raw: np.ndarray) -> list[np.ndarray]:
        """Ids of slices of one length: raw is a matrix of their bytes."""
        ids = self.single[raw]
        out: list[np.ndarray] = [None] * len(ids)  # type: ignore[list-item]
        own = np.arange(len(ids))
        ranks = self._rank(ids[:, :-1], ids[:, 1:])
        while True:
            done = (ranks >= self.none).all(axis=1) if ids.shape[1] > 1 else np.ones(len(ids), dtype=bool)
            for k in np.flatnonzero(done):
                out[own[k]] = ids[k]
            if done.all():
                return out
            ids, ranks, own = ids[~done], ranks[~done], own[~done]
            width = ids.shape[1]
            j = ranks.argmin(axis=1)  # the leftmost of the least
            rows = np.arange(len(ids))
            merged = ranks[rows, j]
            columns = np.arange(width - 1)
            ids = np.take_along_axis(ids, columns + (columns > j[:, None]), 1)
            ids[rows, j] = merged
            if width > 2:
                columns = columns[:-1]
                ranks = np.take_along_axis(ranks, columns + (columns >= j[:, None]), 1)
                left = np.flatnonzero(j > 0)
                ranks[left, j[left] - 1] = self._rank(ids[left, j[left] - 1], ids[left, j[left]])
                right = np.flatnonzero(j < width - 2)
                ranks[right, j[right]] = self._rank(ids[right, j[right]], ids[right, j[right] + 1])
            else:
                ranks = np.empty((len(ids), 0), dtype=np.int64)

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """Ids of one slice by a heap of pairs: O(n log n) for a slice of any length."""
        token = [piece[k : k + 1] for k in range(len(piece))]
        before, after = list(range(-1, len(piece) - 1)), list(range(1, len(piece) + 1))
        heap = [(r, k) for k in range(len(piece) - 1) if (r := self.ranks.get(piece[k : k + 2])) is not None]
        heapq.heapify(heap)
        n = len(piece)
        while heap:
            rank, k = heapq.heappop(heap)
            if not token[k] or (j := after[k]) >= n or self.ranks.get(token[k] + token[j]) != rank:
                continue
            token[k] += token[j]
            token[j] = b""
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
                if (r := self.ranks.get(token[k] + token[after[k]])) is not None:
                    heapq.heappush(heap, (r, k))
            if before[k] >= 0 and (r := self.ranks.get(token[before[k]] + token[k])) is not None:
                heapq.heappush(heap, (r, before[k]))
        return np.array([self.ranks[t] for t in token if t], dtype=np.int64)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of distinct slices; those seen before come from the cache."""
        out = [self.cache.get(p) for p in pieces]
        missing = [k for k, x in enumerate(out) if x is None]
        by_size: dict[int, list[int]] = {}
        for k in missing:
            by_size.setdefault(len(pieces[k]), []).append(k)
        for size, own in by_size.items():
            if size > _LONG:
                for k in own:
                    out[k] = self._merge_long(pieces[k])
            else:
                raw = np.frombuffer(b"".join(pieces[k] for k in own), dtype=np.uint8).reshape(len(own), size)
                for k, ids in zip(own, self._merge_equal(raw), strict=True):
                    out[k] = ids
        if len(self.cache) + len(missing) > CACHE_SLICES:
            self.cache.clear()
        for k in missing[:CACHE_SLICES]:
            if len(pieces[k]) <= _LONG:
                self.cache[pieces[k]] = out[k].astype(np.int32)
        return out

    def encode(self, data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and first: first[k]:first[k+1] are those of text k. data: UTF-8 of all texts; offsets: where they begin, and the end."""
        raw = np.frombuffer(data, dtype=np.uint8)
        points = np.frombuffer(data.decode("utf-8").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        at = np.flatnonzero((raw & 0xC0) != 0x80)  # where code points begin
        heads = np.unique(offsets[:-1][offsets[:-1] < offsets[1:]])
        begin = at[boundaries(points, np.searchsorted(at, heads))]
        ends = np.append(begin[1:], len(raw)) if len(begin) else begin
        if not len(begin):
            return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
        slices = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(np.append(begin, len(raw)).astype(np.int64)), pa.py_buffer(data)])
        coded = slices.dictionary_encode()
        ids = self.merge(coded.dictionary.to_pylist())
        index = coded.indices.to_numpy(zero_copy_only=False)
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.concatenate(ids).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        count = sizes[index]
        upto = np.cumsum(count)
        tokens = flat[np.repeat(starts[index] - (upto - count), count) + np.arange(upto[-1])]
        self.offsets = (begin, ends)
        first = np.concatenate([[0], upto])[np.searchsorted(begin, offsets)]
        return tokens, first

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ids, and where each token's bytes begin (with the end)."""
        sizes = self.sizes[ids]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return self.bytes[np.repeat(self.begin[ids] - upto[:-1], sizes) + np.arange(upto[-1])], upto


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One for each Python worker."""
    return Tokenizer(path)


def _bytes(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """UTF-8 of a step's texts and their offsets."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2].slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if texts.buffers()[2] is not None else b""
    offsets = offsets - offsets[0]
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        parts = [data[a:b].decode("utf-8", "replace").encode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        data, offsets = b"".join(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return data, offsets


def encode(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids array<int>) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            for part, texts in steps(batch, "_text"):
                ids, first = own.encode(*_bytes(texts))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("_text")).mapInArrow(run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            ids = batch.column(1)
            texts = [own.decode(np.array(x, dtype=np.int64))[0].tobytes().decode("utf-8", "replace") if x else "" for x in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, type=pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (little-endian unsigned 32-bit) and of the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            for part, texts in steps(batch, "_text"):
                ids, first = own.encode(*_bytes(texts))
                raw, upto = own.decode(ids)
                packed, plain = memoryview(ids.astype("<u4").tobytes()), memoryview(raw.tobytes())
                edges = upto[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(first)),
                        pa.array([hashlib.sha256(packed[4 * a : 4 * b]).hexdigest() for a, b in zip(first[:-1], first[1:], strict=True)]),
                        pa.array([hashlib.sha256(plain[a:b]).hexdigest() for a, b in zip(edges[:-1], edges[1:], strict=True)]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)
