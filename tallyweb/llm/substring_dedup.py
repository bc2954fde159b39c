"""Substring dedup: repeated passages found in FM-indexes.

A window is WINDOW consecutive words of one document; a word is removed if a window that
covers it also starts in a document with a smaller id.

Routing: equal windows have the same minimizer (the least hash of GRAM consecutive words in
them), so a document is cut into segments, runs of windows with one minimizer, and a shard
holds whole minimizers. Minimizers of a single document can match nothing and are dropped
before any text moves. Equal segments are indexed once, with the smallest id that has them.

Index: a shard's distinct segments, as word ids, form one text. Its suffixes are sorted by
prefix doubling, as deep as a segment is long; the Burrows-Wheeler transform is held in a
wavelet matrix of packed bits with counts, and backward search over it gives the interval
of every suffix of a streamed segment, so the matching statistics. Where a match is WINDOW
words or longer, its interval lies in one run of suffixes that share WINDOW words, and the
least document id of the run says whether the window is a repeat.

Scale: hashes are shuffled for all segments, words only for the distinct ones of shared
minimizers. A task indexes INDEX_WORDS words at a time. A minimizer with more than
MAX_SEGMENTS distinct segments (a passage in a large part of all documents has as many
different surroundings) would not fit an index; its windows become segments of their own,
keyed by their whole content, equal ones are one by an aggregate, and then they are indexed
as all others. Up to CROWDED_KEYS such minimizers are sent to a second pass over the texts,
which moves none; more are joined. Tables are deleted as soon as they have been read.

Words are compared by 64-bit hashes. Defined cases: null and empty texts, and texts with
fewer words than a window, lose nothing; rows with a null id come after all others; rows
that repeat an id are no repeats of each other, and each is judged on its own text; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweb.llm.common import Words, forget, steps, store

WINDOW = 50
GRAM = 8
#: Windows of a segment, at most.
MOST = WINDOW - GRAM + 1
INDEX_WORDS = 1 << 16
MAX_SEGMENTS = 2048
#: So many minimizers (8 bytes each) are sent to every task.
CROWDED_KEYS = 1 << 18
_LAST = (1 << 63) - 1
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(p: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, p, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class _Runs:
    """Hashes of any run of words."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.sums = np.concatenate([[np.uint64(0)], np.add.accumulate(words * _powers(_P, n))]) if n else np.zeros(1, np.uint64)
        self.back = _powers(_P_INVERSE, n + 1)

    def hash(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return _mix((self.sums[start + size] - self.sums[start]) * self.back[start] + np.asarray(size).astype(np.uint64))


def segments_of(grid: Words) -> tuple[np.ndarray, ...]:
    """(text, start, windows, minimizer, content) of the segments of a step's texts; start: a word of its text."""
    words = grid.hashes()
    runs = _Runs(words)
    count = np.diff(grid.first)
    windows = np.maximum(count - WINDOW + 1, 0)
    total = int(windows.sum())
    if not total:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    text = np.repeat(np.arange(len(count)), windows)
    begin = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
    at = grid.first[:-1][text] + begin  # the window's first word in the step
    grams = runs.hash(np.arange(len(words) - GRAM + 1), GRAM)
    least, width = grams, 1  # by doubling: the minimum of MOST grams
    while width * 2 <= MOST:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (MOST - width)], least[MOST - width :])
    mins = least[at]
    new = np.ones(total, dtype=bool)
    new[1:] = (mins[1:] != mins[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(new)
    new[:] |= (np.arange(total) - np.repeat(heads, np.diff(np.append(heads, total)))) % MOST == 0  # long runs of one minimizer are cut
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, total))
    return text[heads], begin[heads], sizes, mins[heads], runs.hash(at[heads], sizes + WINDOW - 1)


_SEGMENT = "_doc long, _row long, _start int, _windows int, _mh long, _sh long"


def _rows(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """_row tells different rows with one id apart."""
    t = F.col(text).cast("string")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("_doc"), F.xxhash64(F.col(doc_id).cast("long"), t).alias("_row"), t.alias("_text"))


def _segments(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in steps(batch, "_text"):
                own, start, windows, mh, sh = segments_of(Words(texts))
                if len(own):
                    take = pa.array(own)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(take), part.column(1).take(take), pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(mh.view(np.int64)), pa.array(sh.view(np.int64))],
                        names=["_doc", "_row", "_start", "_windows", "_mh", "_sh"],
                    )

    return rows.select("_doc", "_row", "_text").mapInArrow(run, _SEGMENT)


def _windows(rows: DataFrame, crowded: np.ndarray) -> DataFrame:
    """Segments of single windows, keyed by their content, of all segments with a crowded minimizer (sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in steps(batch, "_text"):
                grid = Words(texts)
                own, start, windows, mh, _ = segments_of(grid)
                mh = mh.view(np.int64)
                place = np.minimum(np.searchsorted(crowded, mh), len(crowded) - 1)
                here = np.flatnonzero(crowded[place] == mh) if len(mh) else np.empty(0, np.int64)
                if not len(here):
                    continue
                n = windows[here]
                each = np.repeat(here, n)
                shift = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                content = _Runs(grid.hashes()).hash(grid.first[:-1][own[each]] + start[each] + shift, WINDOW)
                take = pa.array(own[each])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array((start[each] + shift).astype(np.int32)), pa.array(np.ones(len(each), dtype=np.int32)), pa.array(content.view(np.int64)), pa.array(mh[each])],
                    names=["_doc", "_row", "_start", "_windows", "_mh", "_sh"],
                )

    return rows.select("_doc", "_row", "_text").mapInArrow(run, _SEGMENT)


class WaveletMatrix:
    """Counts of symbols in a prefix of a text, one packed bit vector for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.depth = max(1, int(sigma - 1).bit_length())
        self.zeros, self.bits, self.ones = [], [], []
        now = symbols
        for level in range(self.depth):
            bit = (now >> (self.depth - 1 - level)) & 1
            packed = np.packbits(np.append(bit, np.zeros(-len(bit) % 64 + 64, dtype=bit.dtype)).astype(bool), bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]).astype(np.int32))
            self.zeros.append(int((bit == 0).sum()))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        self.begin = np.searchsorted(self._order(now), self._order(np.arange(sigma)))

    def _order(self, symbols: np.ndarray) -> np.ndarray:
        """Where the last level puts symbols: by their bits, the last first."""
        out = np.zeros(len(symbols), dtype=np.int64)
        for b in range(self.depth):
            out |= ((symbols.astype(np.int64) >> b) & 1) << (self.depth - 1 - b)
        return out

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        at = at.astype(np.int64)
        for level in range(self.depth):
            word = at >> 6
            rest = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.ones[level][word] + np.bitwise_count(self.bits[level][word] & rest)
            at = np.where((symbol >> (self.depth - 1 - level)) & 1, self.zeros[level] + ones, at - ones)
        return at - self.begin[symbol]


class FMIndex:
    """An index of pieces (arrays of word hashes) for patterns of up to longest words."""

    def __init__(self, pieces: list[np.ndarray], longest: int = 128, window: int = WINDOW):
        self.alphabet, ids = np.unique(np.concatenate(pieces), return_inverse=True)
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes + 1) - 1
        text = np.zeros(int(ends[-1]) + 1, dtype=np.int64)  # symbol 0 ends every piece
        inside = np.ones(len(text), dtype=bool)
        inside[ends] = False
        text[inside] = ids + 1
        self.n, self.window = len(text), window
        self.piece = np.repeat(np.arange(len(pieces)), sizes + 1)
        rank, width = text.copy(), 1
        same = None
        while width < longest:
            # The piece's end is unique to nobody: beyond the text everything is equal, which only patterns with an end would notice.
            after = np.append(rank[width:], np.full(min(width, self.n), -1))[: self.n]
            if width <= window < 2 * width:
                later = np.append(rank[window - width :], np.full(window - width, -1))[: self.n]
                same = (rank.copy(), later)  # together: the first window symbols
            key = rank * (self.n + 2) + after + 1
            order = np.argsort(key, kind="stable")
            new = np.zeros(self.n, dtype=np.int64)
            new[1:] = key[order[1:]] != key[order[:-1]]
            rank[order] = np.cumsum(new)
            width *= 2
            self.suffixes = order
        self.bwt = text[self.suffixes - 1]
        self.wavelet = WaveletMatrix(self.bwt, len(self.alphabet) + 1)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(self.alphabet) + 1))])
        a, b = same[0][self.suffixes], same[1][self.suffixes]
        heads = np.ones(self.n, dtype=bool)
        heads[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.heads = np.flatnonzero(heads)  # of runs of suffixes that share the first window symbols
        self.run = np.cumsum(heads) - 1

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Symbols of words; -1: not in the index."""
        at = np.searchsorted(self.alphabet, words)
        at[at == len(self.alphabet)] = 0
        return np.where(self.alphabet[at] == words, at + 1, -1)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: intervals of the patterns with one more symbol in front."""
        return self.before[symbol] + self.wavelet.rank(symbol, low), self.before[symbol] + self.wavelet.rank(symbol, high)

    def least_by_run(self, values: np.ndarray) -> np.ndarray:
        """For every run of suffixes the least of the pieces' values."""
        return np.minimum.reduceat(values[self.piece[self.suffixes]], self.heads)

    def windows(self, words: list[np.ndarray]) -> list[np.ndarray]:
        """Matching statistics cut at the window, for streamed sequences: per window of each its run of suffixes, -1 if it doesn't occur.

        All sequences advance together, one word to the left in each step. A match that can't be
        extended is begun anew from the right end of the next window that may hold, so its length
        is exact wherever it reaches the window.
        """
        out = [np.full(max(0, len(w) - self.window + 1), -1, dtype=np.int64) for w in words]
        lanes = [(k, self.symbols(w)) for k, w in enumerate(words) if len(w) >= self.window]
        longest = 2 * self.window
        todo = [(k, s, len(s)) for k, s in lanes]  # a lane searches leftward from an end
        while todo:
            most = max(e for _, _, e in todo)
            matrix = np.full((len(todo), most), -1, dtype=np.int64)
            for i, (_, s, e) in enumerate(todo):
                matrix[i, most - e :] = s[:e]
            low, high = np.zeros(len(todo), dtype=np.int64), np.full(len(todo), self.n, dtype=np.int64)
            alive, again = np.arange(len(todo)), []
            for step in range(1, most + 1):
                ends = np.array([todo[i][2] for i in alive])
                alive = alive[ends >= step]
                if not len(alive):
                    break
                symbol = matrix[alive, most - step]
                known = symbol >= 0
                a, b = self.extend(np.maximum(symbol, 0), low[alive], high[alive])
                good = known & (a < b)
                for i in alive[~good]:
                    k, s, e = todo[i]
                    # Words e-step .. e don't match; a window may still end left of the old end.
                    if e - 1 >= self.window:
                        again.append((k, s, e - 1))
                alive, a, b = alive[good], a[good], b[good]
                low[alive], high[alive] = a, b
                if step >= self.window:
                    runs = self.run[a]
                    for i, r in zip(alive, runs, strict=True):
                        k, _, e = todo[i]
                        out[k][e - step] = r
                if step == longest:
                    for i in alive:
                        k, s, e = todo[i]
                        if e - step > 0:
                            again.append((k, s, e - step + self.window - 1))
                    break
            todo = again
        return out


def _answers(rows: DataFrame) -> DataFrame:
    """(_mh, _sh, _least): for each window of a segment the least id of a document that has it.

    rows: (_mh, _sh, _doc, _words binary), distinct segments, partitioned and sorted by _mh.
    """

    def index(mh: list[int], sh: list[int], doc: list[int], words: list[bytes]) -> pa.RecordBatch:
        pieces = [np.frombuffer(w, dtype=np.uint64) for w in words]
        own = FMIndex(pieces)
        least = own.least_by_run(np.array(doc, dtype=np.int64))
        found = [least[r] for r in own.windows(pieces)]
        return pa.RecordBatch.from_arrays([pa.array(mh, type=pa.int64()), pa.array(sh, type=pa.int64()), pa.array(found, type=pa.list_(pa.int64()))], names=["_mh", "_sh", "_least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], []]
        size = 0
        for batch in batches:
            for mh, sh, doc, words in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if size >= INDEX_WORDS and mh != held[0][-1]:
                    yield index(*held)
                    held, size = [[], [], [], []], 0
                for x, v in zip(held, (mh, sh, doc, words), strict=True):
                    x.append(v)
                size += len(words) // 8 + 1
        if size:
            yield index(*held)

    return rows.mapInArrow(run, "_mh long, _sh long, _least array<long>")


def _words_of(rows: DataFrame, wanted: DataFrame, single: bool) -> DataFrame:
    """Words of segments. wanted: (_row, _start, _windows, _mh, _sh, _doc); single: no words, but a row for each window, keyed by its content."""
    lists = wanted.groupBy("_row").agg(F.collect_list(F.struct("_start", "_windows", "_mh", "_sh", "_doc")).alias("_s"))
    texts = rows.select("_row", "_text").join(lists, "_row").select("_text", "_s", "_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, step in steps(batch, "_text"):
                grid = Words(step)
                words = grid.hashes()
                lists = part.column(1)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                flat = lists.flatten()
                start, windows, mh, sh, doc = (flat.field(k) for k in range(5))
                first = np.repeat(grid.first[:-1], sizes) + start.to_numpy(zero_copy_only=False)
                n = windows.to_numpy(zero_copy_only=False)
                if not single:
                    raw = [words[a : a + b + WINDOW - 1].tobytes() for a, b in zip(first.tolist(), n.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([mh, sh, doc, pa.array(raw, type=pa.binary())], names=["_mh", "_sh", "_doc", "_words"])
                    continue
                runs = _Runs(words)
                own = np.repeat(np.arange(len(n)), n)
                shift = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
                content = runs.hash(first[own] + shift, WINDOW).view(np.int64)
                row = np.repeat(part.column(2).to_numpy(zero_copy_only=False), sizes)[own]
                take = pa.array(own)
                yield pa.RecordBatch.from_arrays(
                    [doc.take(take), pa.array(row), pa.array((start.to_numpy(zero_copy_only=False)[own] + shift).astype(np.int32)), pa.array(np.ones(len(own), dtype=np.int32)), pa.array(content), mh.take(take)],
                    names=["_doc", "_row", "_start", "_windows", "_mh", "_sh"],
                )

    return texts.mapInArrow(run, _SEGMENT if single else "_mh long, _sh long, _doc long, _words binary")


def _shared(segments: DataFrame) -> DataFrame:
    """A table of the segments whose minimizer occurs in more than one document. segments: a stored table, which goes.

    The minimizers are a table first: then a hot one's rows can be split in the join.
    """
    ids = store(segments.groupBy("_mh").agg(F.min("_doc").alias("_a"), F.max("_doc").alias("_b")).where("_a < _b").select("_mh"), "minimizers")
    out = store(segments.join(ids, "_mh", "left_semi"), "shared")
    forget(ids)
    forget(segments)
    return out


def _firsts(segments: DataFrame) -> DataFrame:
    """Equal segments once, where the smallest id has them."""
    one = segments.groupBy("_mh", "_sh").agg(F.min(F.struct("_doc", "_row", "_start", "_windows")).alias("_f"))
    return one.select("_mh", "_sh", "_f.*")


def repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(_row, _start, _mask): bit i of _mask marks the window that starts at word _start + i as a repeat."""
    rows = _rows(docs, text, doc_id)
    shared = _shared(store(_segments(rows), "segments"))
    firsts = store(_firsts(shared), "firsts")
    crowded = store(firsts.groupBy("_mh").agg(F.count("*").alias("_n")).where(F.col("_n") > MAX_SEGMENTS).select("_mh"), "crowded")
    n = crowded.count()
    if n:
        # All occurrences, not only first ones, of a crowded minimizer come down to windows.
        if n <= CROWDED_KEYS:
            windows = _windows(rows, np.sort(np.array([r["_mh"] for r in crowded.collect()], dtype=np.int64)))
        else:
            windows = _words_of(rows, shared.join(crowded, "_mh", "left_semi"), single=True)
        windows = _shared(store(windows, "windows"))
        both = store(shared.join(crowded, "_mh", "left_anti").unionByName(windows), "recut")
        for t in (shared, windows, firsts):
            forget(t)
        shared = both
        firsts = store(_firsts(shared), "firsts")
    forget(crowded)
    words = _words_of(rows, firsts, single=False)
    answers = store(_answers(words.repartition("_mh").sortWithinPartitions("_mh")), "answers")
    forget(firsts)
    marked = shared.join(answers, ["_mh", "_sh"]).withColumn("_mask", F.expr("aggregate(transform(_least, (m, i) -> IF(m < _doc, shiftleft(1L, i), 0L)), 0L, (a, x) -> a | x)"))
    out = store(marked.where("_mask <> 0").select("_row", "_start", "_mask").distinct(), "marks")
    forget(shared)
    forget(answers)
    return out


def removal_digest(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space) per row; texts: also kept, that text itself."""
    marks = repeats(docs, text, doc_id).groupBy("_row").agg(F.collect_list(F.struct("_start", "_mask")).alias("_m"))
    both = _rows(docs, text, doc_id).select("doc_id", "_row", "_text").join(marks, "_row", "left").select("doc_id", "_text", "_m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bit = np.arange(64, dtype=np.uint64)
        for batch in batches:
            for part, step in steps(batch, "_text"):
                grid = Words(step)
                joined, at = grid.joined()
                edges = np.append(at, len(joined))
                lists = part.column(2)
                sizes = np.array(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
                flat = lists.flatten()
                change = np.zeros(len(at) + 1, dtype=np.int64)
                if len(flat):
                    first = np.repeat(grid.first[:-1], sizes) + flat.field(0).to_numpy(zero_copy_only=False)
                    own, i = np.nonzero((flat.field(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)[:, None] >> bit) & np.uint64(1))
                    np.add.at(change, first[own] + i, 1)
                    np.add.at(change, first[own] + i + WINDOW, -1)
                gone = np.cumsum(change)[:-1] > 0
                lost = np.concatenate([[0], np.cumsum(gone)])
                n_words, n_removed, digests, kept_texts = np.diff(grid.first), lost[grid.first[1:]] - lost[grid.first[:-1]], [], []
                for k, (a, b) in enumerate(zip(grid.first[:-1].tolist(), grid.first[1:].tolist(), strict=True)):
                    if not n_removed[k]:
                        kept = joined[edges[a] : edges[b]][:-1]
                    else:
                        kept = b" ".join(joined[edges[w] : edges[w + 1] - 1] for w in (np.flatnonzero(~gone[a:b]) + a).tolist())
                    digests.append(hashlib.sha256(kept).hexdigest())
                    if texts:
                        kept_texts.append(kept.decode("utf-8", "replace"))
                columns = [part.column(0), pa.array(n_words.astype(np.int64)), pa.array(n_removed.astype(np.int64)), pa.array(digests)]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(kept_texts, type=pa.string())] if texts else [])], names=["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if texts else [])])

    return both.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if texts else ""))
