"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelchange.session import scratch_path

# Text bytes that one step of a task works on (a longer text is a step of its own).
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back:
    lineage is cut and a lost executor costs one task, not the job."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def strings(column) -> pa.Array:
    """A column of a record batch as a plain string array without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "")


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about ``max_bytes`` together."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    part = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64)) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts, one after another, and the
    offsets of each text's words (one more than there are texts)."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    ends = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    at = lists.offsets.to_numpy().astype(np.int64)
    return flat.filter(full), ends[at - at[0]]


def word_codes(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of the words and the distinct words that they stand for."""
    d = words.dictionary_encode()
    return d.indices.to_numpy().astype(np.int64), d.dictionary


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word."""
    codes, distinct = word_codes(words)
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    return own[codes] if len(codes) else np.zeros(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (each input bit moves each output bit)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_hashes(texts: pa.Array) -> np.ndarray:
    """64-bit hash of each string: those of up to 32 bytes as four numbers at a time
    for all strings, longer ones one by one."""
    data, at = utf8_bytes(texts)
    size = np.diff(at)
    out = np.zeros(len(size), np.uint64)
    for i in np.flatnonzero(size > 32):
        out[i] = xxhash.xxh3_64_intdigest(data[at[i]:at[i + 1]])
    short = np.flatnonzero(size <= 32)
    if len(short):
        cell = at[short][:, None] + np.arange(32)
        there = np.arange(32) < size[short][:, None]
        lanes = np.where(there, np.append(data, np.uint8(0))[np.where(there, cell, len(data))], 0).astype(np.uint8).view(np.uint64)
        with np.errstate(over="ignore"):
            h = mix(size[short].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
            for j in range(4):
                h = mix(h ^ (lanes[:, j] * np.uint64(0xD6E8FEB86659FD93)))
        out[short] = h
    return out


def window_hashes(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words; shorter input has none."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(salt * 2 + 1))
    with np.errstate(over="ignore"):
        for j in range(k):
            out = (out ^ h[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return mix(out)


def per_text(sums: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a flat array over the stretches between offsets."""
    total = np.concatenate([[0], np.cumsum(sums, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def utf8_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary array without nulls, and the texts' offsets in them."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    size = 8 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else 4
    buffers = texts.buffers()
    at = np.frombuffer(buffers[1], np.int64 if size == 8 else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[at[0]:at[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def doc_key(column: str = "doc_id"):
    """Order of documents; a null id comes after all others."""
    return F.col(column).asc_nulls_last()
