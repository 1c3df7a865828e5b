"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed pattern of a word: a run of code points that are none of six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text) -> F.Column:
    """Words of a text column; null counts as none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambling (the finaliser of the public splitmix64 generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_slices(text: bytes):
    """The words of a text, as lists that are cut at blanks about every megabyte."""
    if len(text) <= SLICE_BYTES:
        yield text.split()
        return
    rest = b""
    for at in range(0, len(text), SLICE_BYTES):
        piece = rest + text[at : at + SLICE_BYTES]
        words = piece.split()
        rest = b""
        if at + SLICE_BYTES < len(text) and words and not piece[-1:].isspace():
            rest = words.pop()
        yield words
    if rest:
        yield [rest]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, in order; memory beyond the result is bounded by the slice."""
    parts = [np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) for words in word_slices(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint64)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    n = len(words) - size + 1
    out = mix(words[:n] + np.uint64(size))
    for k in range(1, size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
    return out


def encoded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")
