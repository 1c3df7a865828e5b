"""Periodic runs of words, by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q that no neighbouring word
extends, at least ``least`` words and ``times`` periods long. So each of its words occurs at
least ``times`` times in it, and that is what the search rests on:

1. *Split.* A word that occurs fewer than ``times`` times within its segment cannot be part of a
   run there, so it splits the segment. The pieces are counted anew, for a word may be rare in
   a piece and not in the whole, until no piece splits. Only the smaller pieces are counted
   again; the largest one keeps the counts less what it lost, so a text of n words costs
   O(n log n) however deep the recursion goes. Pieces shorter than ``least`` are dropped.
2. *Lag scan.* What survives is cut into blocks of q words, for every lag q that leaves room
   for a run. A run holds ``times - 1`` whole blocks, equal to one another, so only chains of
   so many blocks with equal hashes are compared word by word, one block beyond either end.
   Chains inside a run whose period divides q are that run again and are passed over.

Texts are independent of each other, so nothing is shuffled. Memory for a text is its bytes
and 4 bytes a word, and some 60 bytes a word of segments that survive the first split.

Defined results: a null, empty or blank text has no words, no runs and an empty collapsed
text. Repeated rows are judged each for itself, other columns are ignored, whatever their names.
An empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.llm.common import mix, word_slices

BASE = np.uint64(0x9E3779B97F4A7C15)
ROWS = 1000  # rows of one batch on the way back

FOUND = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, keep: list[str], text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """The columns ``keep`` of every row, its number of words, its runs and its collapsed text.

    Runs come by start, then period; words are numbered from 0. The collapsed text joins with
    one space the words that no run contains after its first period. ``times`` is 4 at least:
    a chain then reaches so far into its run that the word in its middle tells the run.
    """
    if times < 4 or least < 1:
        raise ValueError("times must be at least 4 and least at least 1")
    if taken := {"n_words", "runs", "collapsed"} & set(keep):
        raise ValueError(f"rename these columns first: {sorted(taken)}")
    chosen = docs.select(*keep, F.col(text).cast("binary").alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = [_judged(t.as_py() or b"", least, times) for t in part.column(len(keep))]
                offsets = np.cumsum([0] + [len(runs) for _, runs, _ in found]).astype(np.int32)
                flat = np.array([r for _, runs, _ in found for r in runs], np.int64).reshape(-1, 3)
                runs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN))
                columns = [
                    *part.columns[:-1],
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.ListArray.from_arrays(offsets, runs),
                    pa.array([c for _, _, c in found], pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_words", "runs", "collapsed"])

    return chosen.mapInArrow(judge, f"{kept}, {FOUND}" if kept else FOUND)


def _judged(text: bytes, least: int, times: int) -> tuple[int, list[tuple[int, int, int]], bytes]:
    code: dict[bytes, int] = defaultdict()
    code.default_factory = code.__len__
    parts = [np.fromiter(map(code.__getitem__, words), np.int32, len(words)) for words in word_slices(text)]
    ids = np.concatenate(parts) if parts else np.empty(0, np.int32)
    runs = [r for s, e in segments(ids, least, times) for r in lag_scan(ids[s:e], s, least, times)]
    runs.sort(key=lambda r: (r[0], r[2]))
    dropped = np.zeros(len(ids), bool)
    for start, length, period in runs:
        dropped[start + period : start + length] = True
    at, kept = 0, []
    for words in word_slices(text):
        gone = dropped[at : at + len(words)]
        kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words))
        at += len(words)
    return len(ids), runs, b" ".join(p for p in kept if p)


def segments(ids: np.ndarray, least: int, times: int) -> Iterator[tuple[int, int]]:
    """The stretches, as (start, end), that recursive splitting at rare words leaves."""
    if len(ids) < least:
        return
    often = np.concatenate([[False], np.bincount(ids)[ids] >= times, [False]])
    starts, ends = np.flatnonzero(often[1:] & ~often[:-1]), np.flatnonzero(often[:-1] & ~often[1:])
    long = ends - starts >= least
    for s, e in zip(starts[long].tolist(), ends[long].tolist()):
        for a, b in _split(ids[s:e].tolist(), least, times):
            yield s + a, s + b


def _split(words: list[int], least: int, times: int) -> Iterator[tuple[int, int]]:
    counts = Counter(words)
    rare = [w for w, c in counts.items() if c < times]
    if not rare:
        yield 0, len(words)
        return
    places = defaultdict(list)
    for k, w in enumerate(words):
        places[w].append(k)
    todo = [(0, len(words), counts, rare)]
    while todo:
        start, end, counts, rare = todo.pop()
        if not rare:
            yield start, end
            continue
        cuts = [start - 1, end]
        for w in rare:  # each has fewer than ``times`` places here
            k = bisect_left(places[w], start)
            cuts += places[w][k : k + counts[w]]
        cuts.sort()
        pieces = [(a + 1, b) for a, b in zip(cuts, cuts[1:]) if b - a > least]
        if not pieces:
            continue
        large = max(pieces, key=lambda p: p[1] - p[0])
        if 2 * (large[1] - large[0]) > end - start:
            pieces.remove(large)
            lost = Counter(words[start : large[0]])
            lost.update(words[large[1] : end])
            counts.subtract(lost)
            todo.append((*large, counts, [w for w in lost if 0 < counts[w] < times]))
        for s, e in pieces:
            own = Counter(words[s:e])
            todo.append((s, e, own, [w for w, c in own.items() if c < times]))


def lag_scan(ids: np.ndarray, offset: int, least: int, times: int) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of one segment, starts counted from ``offset`` on."""
    n = len(ids)
    power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, BASE)]))
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(ids.astype(np.uint64) + BASE) * power[:n])])
    # the run found last that covers a word: its start, end and period
    first, last, own = np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, np.int64)
    runs = []
    for q in range(1, n // times + 1):
        block = np.diff(total[::q])
        same = block[1:] == block[:-1] * power[q]
        chain = same[: len(same) - times + 3].copy()
        for k in range(1, times - 2):
            chain &= same[k : k + len(chain)]
        if not chain.any():
            continue
        edge = np.diff(np.concatenate([[False], chain, [False]]).astype(np.int8))
        a, b = np.flatnonzero(edge == 1) * q, (np.flatnonzero(edge == -1) + times - 2) * q
        middle = (a + b) // 2
        known = (first[middle] <= a) & (last[middle] >= b) & (q % own[middle] == 0)
        for lo, hi in zip(np.maximum(a - q, 0)[~known].tolist(), np.minimum(b + q, n)[~known].tolist()):
            equal = np.concatenate([[False], ids[lo : hi - q] == ids[lo + q : hi], [False]]).astype(np.int8)
            turn = np.diff(equal)
            for s, e in zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist()):
                if e - s + q >= max(least, times * q):
                    s, e = lo + s, lo + e + q
                    first[s:e], last[s:e], own[s:e] = s, e, q
                    runs.append((offset + s, e - s, q))
    return runs
