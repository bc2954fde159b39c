"""Shared pieces: tables in the shared folder, words of whole texts as byte offsets."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every word definition here: \x20 and \x09-\x0D.
BLANKS = " \t\n\x0b\x0c\r"
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Bytes of text that one vectorised step handles at most (a longer text is a step by itself).
STEP_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); a temporary one only where none is set and all of Spark is one process, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tallyweb-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives the loss of executors."""
    path = f"{shared_dir(df.sparkSession)}/tallyweb-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table that store() wrote, once nothing reads it any more."""
    spark, path = df.sparkSession, getattr(df, "_stored_at", None)
    if path:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def words(text):
    """Column: the words of a text (null: none)."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, "[\\x20\\x09-\\x0D]+"))


def steps(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch that hold about STEP_BYTES of the text column, which comes with nulls as empty texts."""
    texts = batch.column(batch.schema.get_field_index(column)).fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(offsets, offsets[at] + STEP_BYTES, side="right")) - 1
        end = min(max(end, at + 1), len(texts))
        yield batch.slice(at, end - at), texts.slice(at, end - at)
        at = end


class Words:
    """Words of a step's texts: bytes data; starts and ends of words; first[k]:first[k+1] are the words of text k."""

    def __init__(self, texts: pa.Array):
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        self.data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        self.offsets = offsets
        inside = _IS_WORD[self.data]
        n = len(inside)
        begins, finishes = inside.copy(), inside.copy()
        if n:
            begins[1:] &= ~inside[:-1]
            finishes[:-1] &= ~inside[1:]
            heads = offsets[:-1][offsets[:-1] < n]
            begins[heads] = inside[heads]
            tails = offsets[1:][offsets[1:] > 0] - 1
            finishes[tails] = inside[tails]
        self.inside, self.begins = inside, begins
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def joined(self, data: np.ndarray | None = None) -> tuple[bytes, np.ndarray]:
        """All words, each followed by one space; where each word starts there."""
        data = self.data if data is None else data
        sizes = self.ends - self.starts
        at = np.cumsum(sizes + 1) - (sizes + 1)
        out = np.full(int((sizes + 1).sum()), 0x20, dtype=np.uint8)
        kept = data[self.inside]
        out[np.arange(len(kept)) + np.cumsum(self.begins[self.inside]) - 1] = kept
        return out.tobytes(), at

    def hashes(self) -> np.ndarray:
        """A 64-bit XXH64 of every word, computed once for each distinct word of the step."""
        import xxhash

        sizes = self.ends - self.starts
        ends = np.cumsum(sizes)
        arr = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(self.data[self.inside]))])
        coded = arr.dictionary_encode()
        own = np.fromiter((xxhash.xxh64_intdigest(x) for x in coded.dictionary.to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
        return own[coded.indices.to_numpy(zero_copy_only=False)] if len(sizes) else np.empty(0, np.uint64)
