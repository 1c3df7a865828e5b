"""Repeated passages of bytes, by phrases that rolling-hash triggers cut.

A byte is removed if a string of ``length`` bytes that covers it starts anywhere else in the
corpus. Strings never cross documents; the input alone decides.

How the corpus' order of suffixes is had without sorting all suffixes:

* *Triggers and phrases.* A rolling hash runs over all ``gram``-byte strings. In each string of
  ``length`` bytes the place of the smallest hash (the leftmost of equals) is its trigger. It
  depends on the string's own bytes alone, so equal strings have equal triggers at equal places.
  Consecutive strings of one trigger form a phrase; a phrase and its right context, up to the
  last byte of its last string, is a few hundred bytes.
* *Dictionary.* Phrases are keyed by the trigger's gram and by the hash of their context. A
  context met twice settles all its strings at once; that is what makes highly repetitive
  text cheap, a copy costs one line for each phrase. A gram met once settles that its phrase
  has no repeats.
* *Parse.* Only where one gram has different contexts, at the edges of repeats, does it go on,
  and then only with one context of each kind. It is cut into blocks of ``BLOCK`` strings at
  places counted from the trigger, which are treated like phrases: all strings of a block share
  its core of bytes, so a core met once settles that none is a repeat, a context met twice that
  all are. Only blocks between the two have their strings compared one by one.

Rows of one key are combined inside each map task before the shuffle, so a passage in a third of
all documents reaches its reducer about once for each task. Comparisons are by two independent
64-bit hashes. Defined results: null and empty texts have no bytes; equal texts of at least
``length`` bytes remove each other; repeated rows count as copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapwise.llm.common import encoded, mix
from gapwise.scratch import Scratch

#: Bytes of text that are worked on together.
GROUP_BYTES = 1 << 20
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
LOCAL_ROWS = 1 << 18
BLOCK = 16


@lru_cache(maxsize=4)
def _letters(which: int) -> np.ndarray:
    return mix(np.arange(256, dtype=np.uint64) + np.uint64(0x1000 * (which + 1)))


def rolling(data: np.ndarray, size: int, which: int) -> np.ndarray:
    """Polynomial hashes (modulo 2**64) of all strings of ``size`` bytes, by doubling."""
    if len(data) < size:
        return np.empty(0, np.uint64)
    base = BASES[which]
    power, width, done = _letters(which)[data], 1, None
    total = 0
    bits = size
    with np.errstate(over="ignore"):
        while True:
            if bits & 1:
                if done is None:
                    done, total = power, width
                else:
                    n = len(data) - total - width + 1
                    done = done[:n] * np.uint64(pow(base, width, 1 << 64)) + power[total : total + n]
                    total += width
            bits >>= 1
            if not bits:
                return mix(done)
            n = len(data) - 2 * width + 1
            power = power[:n] * np.uint64(pow(base, width, 1 << 64)) + power[width : width + n]
            width *= 2


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if rest := width - have:
        out = np.minimum(out[:-rest], out[rest:])
    return out


def phrases(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """For one text: trigger hash, context hash, first string, number of strings, and trigger less first string."""
    if len(data) < length:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    hashes = rolling(data, gram, 0)
    # the upper 32 bits of the hash order the grams, the place breaks ties to the left
    order = ((hashes >> np.uint64(32)) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    trigger = (sliding_least(order, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], trigger[1:] != trigger[:-1])))
    count = np.diff(np.append(first, len(trigger)))
    at = trigger[first]
    return hashes[at], _context(_prefix(data, 1), first, count, length, at - first), first, count, at - first


def blocks(data: np.ndarray, length: int, first: np.ndarray, count: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, ...]:
    """The blocks of phrases: core hash, context hash, first string, number of strings."""
    trigger = first + lead
    low, high = -lead // BLOCK, (count - 1 - lead) // BLOCK
    n = high - low + 1
    owner = np.repeat(np.arange(len(first)), n)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + low[owner]
    begin = trigger[owner] + BLOCK * number
    start = np.maximum(first[owner], begin)
    size = np.minimum((first + count)[owner], begin + BLOCK) - start
    core = _between(_prefix(data, 0), begin + BLOCK - 1, begin + length, 0)
    with np.errstate(over="ignore"):
        core = mix(core + number.astype(np.uint64) * np.uint64(BASES[0]))
    return core, _context(_prefix(data, 1), start, size, length, start - begin), start, size


@lru_cache(maxsize=4)
def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    base = BASES[which]
    up, down = np.full(n + 1, base, np.uint64), np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _prefix(data: np.ndarray, which: int) -> np.ndarray:
    """Running sums from which ``_between`` takes the hash of any part."""
    up, _ = _powers(GROUP_BYTES + 4096, which)
    with np.errstate(over="ignore"):
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(_letters(which)[data] * up[: len(data)], dtype=np.uint64)))


def _between(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    _, down = _powers(GROUP_BYTES + 4096, which)
    with np.errstate(over="ignore"):
        return (prefix[end] - prefix[start]) * down[start]


def _context(prefix: np.ndarray, start: np.ndarray, count: np.ndarray, length: int, shift: np.ndarray) -> np.ndarray:
    """A hash of all bytes of ``count`` strings and of where they lie from their trigger or block."""
    with np.errstate(over="ignore"):
        return mix(_between(prefix, start, start + count - 1 + length, 1) + shift.astype(np.uint64) * np.uint64(BASES[1]) + count.astype(np.uint64))


def stretches(text: bytes, length: int):
    """A text in overlapping stretches of bounded size: every string of ``length`` bytes starts in one."""
    for at in range(0, max(1, len(text) - length + 1), GROUP_BYTES):
        yield at, np.frombuffer(text, np.uint8)[at : at + GROUP_BYTES + length - 1]


def _squeezed(df: DataFrame) -> DataFrame:
    """``df`` with the column ``text`` as compressed bytes, which halves what a shuffle of texts moves."""

    def run(texts: pa.Array) -> pa.Array:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        return pa.array([squeeze(encoded(t)) if t else None for t in texts.to_pylist()], pa.binary())

    return df.withColumn("text", F.arrow_udf(run, "binary")(F.col("text")))


def _bytes_of(value) -> bytes:
    squeezed = value.as_py()
    return zstandard.ZstdDecompressor().decompress(squeezed) if squeezed else b""


PHRASE = "row long, at long, n int, lead int, key long, context long, settled boolean"


def _told(parts) -> pa.RecordBatch:
    """Lines of phrases or blocks, contexts met again inside the task being settled at once.

    A settled line carries a key of its own, so that it is not compared again, while the first
    line of its context goes on with the key that all tasks share.
    """
    rows, at, n, lead, keys, contexts = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((at, rows, contexts, keys))
    rows, at, n, lead, keys, contexts = (c[order] for c in (rows, at, n, lead, keys, contexts))
    again = np.concatenate(([False], (keys[1:] == keys[:-1]) & (contexts[1:] == contexts[:-1])))
    has_again = np.concatenate((again[1:], [False])) & ~again
    with np.errstate(over="ignore"):
        own = mix(rows.astype(np.uint64) * np.uint64(BASES[0]) + at.astype(np.uint64))
    keys = np.where(again, own, keys)
    # the first of several is settled as well, but stays to be met by other tasks
    columns = [rows, at, n.astype(np.int32), lead.astype(np.int32), keys.view(np.int64), contexts.view(np.int64), again | has_again]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "at", "n", "lead", "key", "context", "settled"])


def _gathered(batches, lines) -> Iterator[pa.RecordBatch]:
    """The lines of all texts, told in groups of bounded size."""
    parts, held = [], 0
    for batch in batches:
        for part in lines(batch):
            parts.append(part)
            held += len(part[0])
            if held >= LOCAL_ROWS:
                yield _told(parts)
                parts, held = [], 0
    if parts:
        yield _told(parts)


def _phrase_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """One line for each phrase of plain texts."""

    def lines(batch):
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for base, data in stretches(encoded(text.as_py() or ""), length):
                keys, contexts, first, count, lead = phrases(data, length, gram)
                if len(first):
                    yield np.full(len(first), row), first + base, count, lead, keys, contexts

    return texts.select("row", "text").mapInArrow(lambda batches: _gathered(batches, lines), PHRASE)


def _listed(batch, length: int):
    """Row, base, data and the listed phrases or blocks of each stretch: (first, count, lead) from its base."""
    for row, value, listed in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
        text = _bytes_of(value)
        at, n, lead = (listed.values.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "n", "lead"))
        for base, data in stretches(text, length):
            here = (at >= base) & (at < base + GROUP_BYTES)
            if here.any():
                yield row, base, data, at[here] - base, n[here], lead[here]


def _block_rows(texts: DataFrame, length: int) -> DataFrame:
    """One line for each block of the listed phrases of squeezed texts (row, text, listed)."""

    def lines(batch):
        for row, base, data, first, count, lead in _listed(batch, length):
            core, context, start, size = blocks(data, length, first, count, lead)
            yield np.full(len(start), row), start + base, size, np.zeros(len(start), np.int64), core, context

    return texts.mapInArrow(lambda batches: _gathered(batches, lines), PHRASE)


def _string_rows(texts: DataFrame, length: int) -> DataFrame:
    """(row, at, a, b): two hashes of every string inside the listed blocks."""

    def run(batches):
        for batch in batches:
            for row, base, data, first, count, _ in _listed(batch, length):
                at = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                a, b = (mix(_between(_prefix(data, k), at, at + length, k)) for k in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), row)), pa.array(at + base), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["row", "at", "a", "b"]
                )

    return texts.mapInArrow(run, "row long, at long, a long, b long")


def _compared(lines: DataFrame) -> DataFrame:
    """Lines that are settled, or open: one of each context of a key that has several."""
    by_key, by_both = Window.partitionBy("key"), Window.partitionBy("key", "context")
    return (
        lines.withColumn("low", F.min("context").over(by_key))
        .withColumn("high", F.max("context").over(by_key))
        .withColumn("same", F.count("*").over(by_both))
        .withColumn("nth", F.row_number().over(by_both.orderBy("row", "at")))
        .withColumn("settled", F.col("settled") | (F.col("same") > 1))
        .withColumn("open", (F.col("low") < F.col("high")) & (F.col("nth") == 1))
        .filter("settled OR open")
        .select("row", "at", "n", "lead", "settled", "open")
    )


def _open_texts(texts: DataFrame, kinds: DataFrame) -> DataFrame:
    """(row, text, listed) of the texts that have open lines."""
    listed = kinds.filter("open").groupBy("row").agg(F.collect_list(F.struct("at", "n", "lead")).alias("listed"))
    return texts.join(listed, "row").select("row", "text", "listed")


RESULT = "row long, id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def _result(texts: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            out = []
            for row, i, value, whole, starts in zip(*(c.to_pylist() if k != 2 else c for k, c in enumerate(batch.columns))):
                text = _bytes_of(value)
                if whole and len(text) >= length:
                    spans = [(0, len(text))]
                else:
                    spans = []
                    for at, n in sorted((s["at"], s["n"]) for s in starts or ()):
                        end = at + n - 1 + length
                        if spans and at <= spans[-1][1]:
                            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
                        else:
                            spans.append((at, end))
                digest, last = hashlib.sha256(), 0
                for start, end in spans:
                    digest.update(text[last:start])
                    last = end
                digest.update(text[last:])
                out.append((row, i, len(text), sum(e - s for s, e in spans), len(spans), digest.hexdigest(), [{"start": s, "end": e} for s, e in spans]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (*[pa.int64()] * 5, pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))],
                    names=["row", "id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
                )

    return texts.mapInArrow(run, RESULT)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, gram: int = 32) -> DataFrame:
    """One row for each document: id, n_bytes, n_removed, n_spans, kept_sha256, spans (bytes)."""
    scratch = Scratch(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # one line for each different text and id; its row number is drawn from both, and its copies are counted
    keyed = base.withColumn("row", F.xxhash64("id", "text", F.col("id").isNull()))
    listed, _ = scratch.write(keyed.select("row", "id", F.sha2("text", 256).alias("sha")))
    groups = listed.filter("sha IS NOT NULL").groupBy("sha").agg(F.min("row").alias("first"), F.count("*").alias("copies"))
    marked = listed.join(groups, "sha", "left").select("row", (F.coalesce("copies", F.lit(1)) > 1).alias("whole"), F.coalesce(F.col("first") == F.col("row"), F.lit(True)).alias("stands"))
    marks, _ = scratch.write(marked.groupBy("row").agg(F.max("whole").alias("whole"), F.max("stands").alias("stands")))

    # Copies of a text that stands for them are left out; a row that comes twice may stay twice,
    # since each of its strings does occur elsewhere.
    copies, _ = scratch.write(marks.filter("NOT stands").select("row"))
    texts = keyed.select("row", "text").filter(F.octet_length("text") >= length).join(copies, "row", "left_anti")
    kinds, _ = scratch.write(_compared(_phrase_rows(texts, length, gram)))
    squeezed = _squeezed(texts)
    finer, _ = scratch.write(_compared(_block_rows(_open_texts(squeezed, kinds), length)))
    strings = _string_rows(_open_texts(squeezed, finer), length)
    met = strings.groupBy("a", "b").agg(F.count("*").alias("c")).filter("c > 1").select("a", "b")
    hits = strings.join(met, ["a", "b"], "left_semi").select("row", "at", F.lit(1).alias("n"))
    every = kinds.filter("settled").select("row", "at", "n").union(finer.filter("settled").select("row", "at", "n")).union(hits)
    starts = every.groupBy("row").agg(F.collect_list(F.struct("at", "n")).alias("starts"))
    # a whole text that is repeated is removed as it is; the others get their starts
    work = _squeezed(keyed).join(marks.select("row", "whole"), "row").join(starts, "row", "left")
    done = _result(work.select("row", "id", "text", "whole", "starts"), length)
    return done.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
