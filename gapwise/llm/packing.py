"""Packing tokenised documents into sequences, by patterns fitted with non-negative least squares.

1. Documents are tokenised and cut into pieces of at most ``size`` tokens; only the pieces'
   lengths go on. Their histogram has at most ``size`` lines, whatever the corpus.
2. Lengths are rounded up to ``grain``; all patterns of at most ``most_docs`` rounded lengths
   that fill a sequence are enumerated, and non-negative least squares fits how often to
   repeat each so that together they use up the histogram.
3. The counts are rounded down, so that no length is used up twice, and their slots given to real lengths, longest first. What is
   left, and what room is left, is packed by best fit, longest first, many equal lengths at a
   time. The result is a plan: for each length, which run of its pieces goes where.
4. Pieces are ranked within their length (counts for each partition, then a running sum), look
   up their slot in the plan, and sum up their offsets within their sequence.

The plan is as large as the histogram of lengths, not the corpus, and so may be shipped.

Defined results: null texts count as empty; every document ends with the token ``end_id``, so
an empty one is a piece of one token; repeated rows are packed as often as they come.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapwise.scratch import Scratch

CACHED_WORDS = 800_000
TEXTS_AT_ONCE = 1024
LETTERS_AT_ONCE = 1 << 20  # of the texts that are looked up together, besides one longer text
MARKS = ".,!?;:"
WEIGHT = 1.0
FITTED_SHARE = 0.9


class WordTokens:
    """Token ids of texts, word by word: the tokenizer drops white space, so blanks may separate.

    Only for tokenizers whose ids of a text are those of its space-separated words in turn, as
    ``word_bpe_49k.json``. Words are remembered up to a bound; of those, the ones met since half
    of it was learned outlast it, so a common word is not encoded again and again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_padding()
        self._tokenizer.no_truncation()
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._marks = {mark: self._alone([mark])[0] for mark in MARKS}
        # what was learned last, and what was before: half of the bound each
        self._ids: dict[str, bytes] = {}
        self._stems: dict[str, bytes] = {}
        self._older_ids: dict[str, bytes] = {}
        self._older_stems: dict[str, bytes] = {}

    def _alone(self, words: list[str]) -> list[bytes]:
        return [np.array(found.ids, "<u4").tobytes() for found in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _learn_stems(self, stems: list[str]) -> None:
        """Words of letters end in a token that says so; many are encoded as one text and cut there."""
        for at in range(0, len(stems), 1024):
            part = stems[at : at + 1024]
            ids = np.array(self._tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = 4 * (np.flatnonzero(self._ends[ids]) + 1)
            if len(ends) == len(part):
                raw, cuts = ids.tobytes(), [0, *ends.tolist()]
                self._stems.update(zip(part, map(raw.__getitem__, map(slice, cuts, cuts[1:]))))
            else:
                self._stems.update(zip(part, self._alone(part)))

    @staticmethod
    def _recalled(wanted: set[str], known: dict[str, bytes], older: dict[str, bytes]) -> set[str]:
        """Those of ``wanted`` that are in neither; the others are known afterwards."""
        wanted = wanted.difference(known)
        again = older.keys() & wanted  # goes through the smaller one
        known.update(zip(again, map(older.__getitem__, again)))
        return wanted.difference(again)

    def _learn(self, words: set[str]) -> None:
        marks, plain, marked, odd = self._marks, [], [], []
        for word in words:
            if not word:
                self._ids[word] = b""
                continue
            # other letters than ASCII may be lowered differently by the tokenizer: left as they are
            if word.isalpha():
                (plain if word.isascii() or word.lower().isalpha() else odd).append(word)
            elif word[-1] in marks and (stem := word[:-1]).isalpha() and stem.lower().isalpha():
                marked.append(word)
            else:
                odd.append(word)
        plain_stems = [word.lower() if word.isascii() else word for word in plain]
        marked_stems = [word[:-1].lower() if word.isascii() else word[:-1] for word in marked]
        self._learn_stems(list(self._recalled({*plain_stems, *marked_stems}, self._stems, self._older_stems)))
        found = self._stems.__getitem__
        self._ids.update(zip(plain, map(found, plain_stems)))
        self._ids.update((word, found(stem) + marks[word[-1]]) for word, stem in zip(marked, marked_stems))
        for at in range(0, len(odd), 1024):
            self._ids.update(zip(odd[at : at + 1024], self._alone(odd[at : at + 1024])))

    def of(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        if len(self._ids) > CACHED_WORDS // 2:
            self._older_ids, self._ids = self._ids, {}
        if len(self._stems) > CACHED_WORDS // 2:
            self._older_stems, self._stems = self._stems, {}
        # the tokenizer lowers its input; letters of ASCII alone may as well be lowered before they are split
        spaced = pa.array([(t.lower() if t.isascii() else t).replace("\n", " ") for t in texts], pa.large_string())
        split = pa.compute.split_pattern(spaced, " ")
        coded = split.values.dictionary_encode()
        words, code = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        self._learn(self._recalled(set(words), self._ids, self._older_ids))
        known = list(map(self._ids.__getitem__, words))
        length = np.fromiter(map(len, known), np.int64, len(known)) // 4
        start = np.cumsum(length) - length
        upto = np.concatenate([[0], np.cumsum(length[code])])
        place = np.repeat(start[code] - upto[:-1], length[code]) + np.arange(upto[-1])
        ids = np.frombuffer(b"".join(known), "<u4")[place].tobytes()
        ends = (4 * upto[split.offsets.to_numpy()]).tolist()
        return [ids[i:j] for i, j in zip(ends, ends[1:])]


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """One tokenizer for each worker process, so that its words outlast a task."""
    return WordTokens(path)


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts to be looked up together: bounded in number and, unless one is longer, in letters."""
    begin, held = 0, 0
    for k, text in enumerate(texts):
        if k > begin and (held + len(text) > LETTERS_AT_ONCE or k - begin == TEXTS_AT_ONCE):
            yield begin, k
            begin, held = k, 0
        held += len(text)
    if texts:
        yield begin, len(texts)


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, size: int, end_id: int) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document; ``start`` counts the tokens before."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer_path)
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for begin, until in _groups(texts):
                rows = []
                for i, ids in zip(names[begin:until], tokens.of(texts[begin:until])):
                    ids += end
                    for k, byte in enumerate(range(0, len(ids), 4 * size)):
                        cut = ids[byte : byte + 4 * size]
                        rows.append((i, k, byte // 4, len(cut) // 4, zlib.crc32(cut)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["id", "piece", "start", "length", "ids_crc32"],
                )

    schema = "id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the public active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    for _ in range(3 * a.shape[0]):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= tolerance * max(1.0, float(b.max(initial=0))):
            break
        active[best] = True
        while True:
            on = np.flatnonzero(active)
            part = a[:, on]
            s = np.linalg.solve(part.T @ part + 1e-10 * np.eye(len(on)), part.T @ b)
            if (s > 0).all():
                x[:] = 0
                x[on] = s
                break
            bad = s <= 0
            step = (x[on][bad] / (x[on][bad] - s[bad] + 1e-300)).min()
            x[on] += step * (s - x[on])
            active[on[x[on] <= 1e-12]] = False
            x[~active] = 0
            if not active.any():
                break
    return x


def patterns(cells: int, most_docs: int) -> list[tuple[int, ...]]:
    """All multisets of 1 to ``most_docs`` rounded lengths that sum to ``cells``."""
    out = []
    for n in range(1, most_docs + 1):
        for part in combinations_with_replacement(range(1, cells + 1), n - 1):
            last = cells - sum(part)
            if last >= (part[-1] if part else 1):
                out.append((*part, last))
    return out


def plan(histogram: dict[int, int], size: int, grain: int, most_docs: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Sequences to fill: ((length, how many), ...) and how often."""
    left = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        left[length] += n
    # open sequences by the room they have left: contents and how many
    room: list[list[tuple[tuple[tuple[int, int], ...], int]]] = [[] for _ in range(size + 1)]
    cells = -(-size // grain)
    binned = np.zeros(cells, np.float64)
    np.add.at(binned, (np.arange(1, size + 1) + grain - 1) // grain - 1, left[1:])
    if binned.any():
        every = patterns(cells, most_docs)
        a = np.zeros((cells, len(every)))
        for k, pattern in enumerate(every):
            for cell in pattern:
                a[cell - 1, k] += 1
        # long pieces are the hard ones to place, so their lines weigh more; a part is left to best fit
        scale, weight = binned.sum(), np.arange(1, cells + 1, dtype=np.float64) ** WEIGHT
        fitted = nonnegative_least_squares(a * weight[:, None], binned / scale * weight)
        counts = np.floor(fitted * scale * FITTED_SHARE + 1e-6).astype(np.int64)
        unused = binned.astype(np.int64)
        for k in np.argsort(-counts, kind="stable"):
            # rounded down to what the histogram still holds: a pattern with a hole would waste its room
            need = a[:, k].astype(np.int64)
            on = need > 0
            repeats = int(min(counts[k], (unused[on] // need[on]).min()))
            if repeats <= 0:
                continue
            unused -= repeats * need
            groups = [((), repeats)]
            for cell in sorted(every[k], reverse=True):
                low, filled = (cell - 1) * grain, []
                for held, n in groups:
                    length = min(cell * grain, size)
                    while n and length > low:
                        if take := int(min(n, left[length])):
                            left[length] -= take
                            n -= take
                            filled.append(((*held, (length, 1)), take))
                        else:
                            length -= 1
                    if n:
                        filled.append((held, n))
                groups = filled
            for held, n in groups:
                if held:
                    room[size - sum(x * m for x, m in held)].append((held, n))
    occupied = [r for r in range(size + 1) if room[r]]
    for length in range(size, 0, -1):
        rest = int(left[length])
        while rest:
            k = bisect_left(occupied, length)
            if k == len(occupied):
                fresh = -(-rest // (size // length))
                room[size].append(((), fresh))
                occupied.append(size)
                continue
            space = occupied[k]
            held, n = room[space].pop()
            each = min(space // length, rest)
            used = min(n, rest // each)
            if n > used:
                room[space].append((held, n - used))
            if not room[space]:
                occupied.pop(k)
            rest -= used * each
            after = space - each * length
            if not room[after]:
                occupied.insert(bisect_left(occupied, after), after)
            room[after].append(((*held, (length, each)), used))
    return [(held, n) for groups in room for held, n in groups if held]


def slots(filled: list[tuple[tuple[tuple[int, int], ...], int]]) -> dict[int, np.ndarray]:
    """For each length, rows of (first rank, first sequence, pieces in each, first place)."""
    taken: dict[int, int] = {}
    out: dict[int, list] = {}
    sequence = 0
    for held, n in filled:
        place = 0
        for length, each in held:
            start = taken.get(length, 0)
            out.setdefault(length, []).append((start, sequence, each, place))
            taken[length] = start + n * each
            place += each
        sequence += n
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 4096,
    end_id: int = 1,
    grain: int = 16,
    most_docs: int = 3,
) -> DataFrame:
    """One row for each piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    scratch = Scratch(docs.sparkSession)
    cut = pieces(docs, tokenizer_path, id_col, text_col, size, end_id)
    numbered = cut.withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id())
    stored, _ = scratch.write(numbered)
    counts, _ = scratch.write(stored.groupBy("length", "part").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` lines
    where = slots(plan(histogram, size, grain, most_docs))

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("length", "part", "base")
    own = Window.partitionBy("length", "part").orderBy("seq")
    ranked = stored.withColumn("nth", F.row_number().over(own) - 1).join(base, ["length", "part"])
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))

    def look_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence, place = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            for length, at in frame.groupby("length").indices.items():
                rows, rank = where[length], frame["rank"].to_numpy()[at]
                row = rows[np.searchsorted(rows[:, 0], rank, side="right") - 1]
                sequence[at] = row[:, 1] + (rank - row[:, 0]) // row[:, 2]
                place[at] = row[:, 3] + (rank - row[:, 0]) % row[:, 2]
            yield frame.drop(columns="rank").assign(sequence_id=sequence, place=place)

    types = {**dict(ranked.dtypes), "sequence_id": "bigint", "place": "bigint"}
    placed = ranked.mapInPandas(look_up, ", ".join(f"{c} {t}" for c, t in types.items() if c != "rank"))
    within = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0)))
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
