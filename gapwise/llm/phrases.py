"""Phrase collocations, by multikey three-way quicksort of suffix pointers.

Texts fall into pieces at punctuation and line ends, pieces into words. A suffix pointer is the
place of a word with the words that follow it in its piece, ``longest`` of them at most.

1. *Words.* One pass counts the words of every language, summed in the tasks first.
2. *Route.* A second pass sends each pointer to a bucket by its leading words: up to the first
   one that is not hot, where hot words are those above a share of all words. So everything
   that starts with a phrase meets in one bucket, unless all words of the phrase are hot, and a
   bucket's keys are never larger than a hot word's least count. Equal pointers of a task are
   counted before they travel. Phrases of hot words only are counted in the tasks as well
   and travel as counts, to a bucket by the whole phrase.
3. *Sort.* A bucket sorts its pointers by multikey three-way quicksort: less, equal and greater
   than a pivot at one word's depth; only the equal part goes on to the next word. The size of an
   equal part is the count of its phrase. A part with fewer pointers than ``least`` is abandoned:
   no phrase in it can be frequent.
4. *Score.* Counts are joined to the two sides of every cut of a candidate. Phrases inside a
   longer candidate as frequent as they are go. Ranks come from two rounds of windows.

A bucket holds about ``bucket_words`` pointers, whatever the size of the input: the number of
buckets grows with it. The list of hot words has at most ``MOST_HOT`` lines, as each holds a
share of the words of 1 / MOST_HOT or more, and is the only thing that is broadcast.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows
count each time. Only ``text`` and ``lang`` are read, other columns have no effect. An empty
table, or one without frequent phrases, gives an empty table.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapwise.llm.common import LOWER, mix, word_slices
from gapwise.scratch import Scratch

#: Fixed separators: a piece ends at these bytes; words are parted by blank and tab.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
STOP = b"."
_FOLD = LOWER.translate(bytes.maketrans(ENDS, STOP * len(ENDS)))

MOST_HOT = 1 << 18
HOT_SHARE, HOT_WORDS = 1024, 1_000_000  # a word is hot above a 1024th of all words, or above a million
CHUNK_WORDS = 1_000_000  # words that a task gathers before it sends their pointers
ID_BITS = 21  # numbers of a chunk's words, see _counted_rows
SALTS = 8  # parts of a frequent key in joins
RANK_PARTS = 32  # parts of a language that are ranked on their own first
_POINTERS = "bucket int, lang string, words binary, hot int, pointers binary, counts binary"


def collocations(
    docs: DataFrame, least: int = 100, longest: int = 5, covered: int = 100, most: int = 2000, bucket_words: int = 1_000_000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``most`` best phrases of every language.

    Candidates are phrases of 2 to ``longest`` words with a = f(phrase) >= ``least``; the cut
    with the lowest floor(1000 a n / (l r)) counts, of equal ones the first. A candidate inside a
    longer one with 100 f(longer) >= ``covered`` a goes.
    """
    scratch = Scratch(docs.sparkSession)
    read = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    words, _ = scratch.write(word_counts(read))
    total = words.agg(F.sum("f")).first()[0] or 0
    buckets = max(1, -(-total // bucket_words))
    sent = pointers(read, hot_words(words, total), buckets, longest)
    phrases, _ = scratch.write(frequent_phrases(sent, buckets, least, longest))
    return ranked(scored(phrases, words, least, covered, scratch), most)


def _slices(text: bytes) -> Iterator[list[bytes]]:
    """Lower-case words and stops, in lists of bounded size; no word holds the byte of a stop."""
    yield from word_slices(text.translate(_FOLD).replace(STOP, b" . "))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f): all occurrences of each word, summed within the tasks first."""

    def lines(found: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counts in found.items():
            counts.pop(STOP, None)
            columns = [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            yield from pa.Table.from_arrays(columns, names=["lang", "word", "f"]).to_batches(50_000)
        found.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for words in _slices(text.as_py()):
                    found[lang].update(words)
                    if len(found[lang]) > CHUNK_WORDS // 4:
                        yield from lines(found)
            if sum(map(len, found.values())) > CHUNK_WORDS // 4:
                yield from lines(found)
        yield from lines(found)

    counted = docs.mapInArrow(count, "lang string, word binary, f bigint")
    return counted.groupBy("lang", F.col("word").cast("string").alias("word")).agg(F.sum("f").alias("f"))


def hot_words(words: DataFrame, total: int) -> dict[str, set[bytes]]:
    """Words by language that are routed with what follows them; fewer than ``MOST_HOT`` in all."""
    least = max(min(total // HOT_SHARE, HOT_WORDS), total // MOST_HOT)
    hot: dict[str, set[bytes]] = defaultdict(set)
    for row in words.filter(F.col("f") > least).toLocalIterator():
        hot[row["lang"]].add(row["word"].encode())
    return dict(hot)


def pointers(docs: DataFrame, hot: dict[str, set[bytes]], buckets: int, longest: int) -> DataFrame:
    """Suffix pointers, packed by task, bucket and language.

    A line has a list of its words, ``hot`` hot ones first, and the pointers as a matrix of
    places in that list from 1, one depth after the other and 0 where a piece has ended. A
    negative first place marks a phrase of hot words with its count.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = _Chunk(), 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                chunk.add(lang, [STOP])
                for words in _slices(text.as_py()):
                    chunk.add(lang, words)
                    held += len(words)
                    if held >= CHUNK_WORDS:
                        # the last pointers wait for the words that follow them
                        rest = chunk.last(lang, longest - 1)
                        yield from chunk.packed(shared.value, buckets, longest, {lang: len(rest)})
                        chunk, held = _Chunk(), 0
                        chunk.add(lang, rest)
        yield from chunk.packed(shared.value, buckets, longest, {})

    return docs.mapInArrow(send, _POINTERS)


class _Chunk:
    """Words of one stretch of documents, as numbers by language; a stop is 0."""

    def __init__(self):
        self.codes: dict[str, dict[bytes, int]] = {}
        self.streams: dict[str, list[np.ndarray]] = {}

    def add(self, lang: str, words: list[bytes]) -> None:
        if lang not in self.codes:
            self.codes[lang] = defaultdict()
            self.codes[lang].default_factory = self.codes[lang].__len__
            self.codes[lang][STOP]
            self.streams[lang] = []
        self.streams[lang].append(np.fromiter(map(self.codes[lang].__getitem__, words), np.int32, len(words)))

    def last(self, lang: str, n: int) -> list[bytes]:
        """The last n words and stops of a language."""
        words = list(self.codes[lang])
        return [words[k] for k in np.concatenate(self.streams[lang])[-n:].tolist()] if n else []

    def packed(self, hot: dict, buckets: int, longest: int, waiting: dict[str, int]) -> Iterator[pa.RecordBatch]:
        for lang, parts in self.streams.items():
            names = np.array([*self.codes[lang], None], object)[:-1]
            is_hot = np.fromiter(map(hot.get(lang, frozenset()).__contains__, names), bool, len(names))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))
            stream = np.concatenate(parts)
            rows, counts = _suffixes(stream, len(stream) - waiting.get(lang, 0), longest)
            start = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
            rows, counts, bucket = _routed(rows, counts, is_hot, hashes, start, buckets)
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)) if len(bucket) else []
            for a, b in zip(edges, edges[1:]):
                words, n_hot, matrix = _renumbered(rows[a:b], is_hot)
                columns = [
                    pa.array([bucket[a]], pa.int32()),
                    pa.array([lang], pa.string()),
                    pa.array([b" ".join(names[words])], pa.binary()),
                    pa.array([n_hot], pa.int32()),
                    pa.array([matrix.tobytes()], pa.binary()),
                    pa.array([counts[a:b].astype(np.int32).tobytes()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "lang", "words", "hot", "pointers", "counts"])


def _suffixes(stream: np.ndarray, upto: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct suffixes of two words or more that start before ``upto``, and their counts."""
    padded = np.concatenate([stream, np.zeros(longest, np.int32)])
    start = np.flatnonzero((padded[:upto] > 0) & (padded[1 : upto + 1] > 0)).astype(np.int32)
    rows = np.empty((len(start), longest), np.int32)
    alive = np.ones(len(start), bool)
    for k in range(longest):
        word = padded[start + k]
        alive &= word > 0
        rows[:, k] = np.where(alive, word, 0)
    return _counted_rows(rows, np.ones(len(rows), np.int32))


def _routed(rows, counts, is_hot, hashes, start, buckets: int):
    """Rows, counts and buckets in order of buckets, with the phrases of hot words added."""
    route = np.full(len(rows), start)
    going = np.ones(len(rows), bool)  # all words so far are hot
    parts = []
    for k in range(rows.shape[1]):
        word = rows[:, k]
        going &= word > 0
        route[going] = mix(route[going] * np.uint64(0x9E3779B97F4A7C15) + hashes[word[going]])
        going &= is_hot[word]
        if k and going.any():
            short = rows[going].copy()
            short[:, k + 1 :] = 0
            short, n = _counted_rows(short, counts[going])
            key = np.full(len(short), start)
            for j in range(k + 1):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[short[:, j]])
            short[:, 0] *= -1
            parts.append((short, n, key))
    parts.append((rows, counts, route))
    rows, counts, key = (np.concatenate([p[i] for p in parts]) for i in range(3))
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return rows[order], counts[order], bucket[order]


def _renumbered(rows: np.ndarray, is_hot: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """The words of some rows, hot ones first, how many are hot, and the rows as places in that list."""
    used, place = np.unique(np.abs(rows), return_inverse=True)
    words = used[used > 0]
    order = np.argsort(~is_hot[words], kind="stable")
    number = np.zeros(len(used), np.int32)
    number[len(used) - len(words) + order] = np.arange(1, len(words) + 1)
    matrix = number[place.reshape(rows.shape)]
    matrix[:, 0] *= np.sign(rows[:, 0])
    return words[order], int(is_hot[words].sum()), matrix.T.astype(_kind(len(words)))


def _kind(words: int):
    return np.int16 if words < 1 << 15 else np.int32


def _counted_rows(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and the sums of their counts; numbers are below 2 ** ID_BITS."""
    keys = []
    for at in range(0, rows.shape[1], 3):  # three numbers in a key
        key = np.zeros(len(rows), np.int64)
        for k in range(at, min(at + 3, rows.shape[1])):
            key = (key << ID_BITS) | rows[:, k]
        keys.append(key)
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    return rows[order[first]], np.add.reduceat(counts[order], first) if len(first) else counts


def frequent_phrases(sent: DataFrame, buckets: int, least: int, longest: int) -> DataFrame:
    """(lang, phrase, size, f) of all phrases of 2 to ``longest`` words with f >= ``least``."""

    def sort(lines: pd.DataFrame) -> pd.DataFrame:
        found = []
        for lang, own in lines.groupby("lang"):
            code: dict[bytes, int] = defaultdict()
            code.default_factory = lambda code=code: len(code) + 1
            rows, hot = [], np.zeros(1, np.int32)
            for words, n_hot, matrix in zip(own["words"], own["hot"], own["pointers"]):
                words = words.split(b" ")
                number = np.fromiter(map(code.__getitem__, words), np.int32, len(words))
                hot = np.union1d(hot, number[:n_hot])
                matrix = np.frombuffer(matrix, _kind(len(words))).reshape(longest, -1)
                real = np.concatenate([np.zeros(1, np.int32), number])[np.abs(matrix)]
                real[0] *= np.sign(matrix[0])
                rows.append(real)
            rows = np.concatenate(rows, axis=1)
            counts = np.concatenate([np.frombuffer(c, np.int32) for c in own["counts"]])
            names = [b"", *code]
            is_hot = np.zeros(len(names), bool)
            is_hot[hot[hot > 0]] = True
            whole = rows[0] > 0
            for part, summed in ((whole, False), (~whole, True)):
                own_rows, own_counts = np.abs(rows[:, part]), counts[part]
                for depth, place, f in quicksorted(own_rows, own_counts, least, is_hot, summed):
                    found.append((lang, b" ".join([names[k] for k in own_rows[:depth, place]]).decode(), depth, f))
        return pd.DataFrame(found, columns=["lang", "phrase", "size", "f"])

    return sent.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(sort, "lang string, phrase string, size int, f bigint")


def quicksorted(columns: np.ndarray, counts: np.ndarray, least: int, is_hot: np.ndarray, summed: bool) -> Iterator[tuple[int, int, int]]:
    """(depth, place of one pointer, count) of the frequent equal parts that are counted here.

    Phrases of hot words only are counted where they came ``summed``: as rows that end with the phrase.
    Everything else is counted in the rows of whole suffixes.
    """
    todo = [(np.arange(columns.shape[1], dtype=np.int32), 0, True)]
    while todo:
        part, depth, only_hot = todo.pop()
        if counts[part].sum(dtype=np.int64) < least:  # abandoned, with all that starts like this
            continue
        word = columns[depth][part]
        pivot = np.sort(word[:: max(1, len(word) // 9)])
        pivot = pivot[len(pivot) // 2]
        less, equal = word < pivot, word == pivot
        same = part[equal]
        if len(same) < len(part):
            todo.append((part[less], depth, only_hot))
            todo.append((part[~(less | equal)], depth, only_hot))
        if pivot == 0:  # the piece has ended
            continue
        hot = only_hot and bool(is_hot[pivot])
        size = depth + 1
        if size > 1 and hot == summed:
            counted = same if not summed else same[columns[size][same] == 0] if size < len(columns) else same
            if (f := int(counts[counted].sum(dtype=np.int64))) >= least:
                yield size, int(same[0]), f
        if size < len(columns):
            todo.append((same, size, hot))


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join on keys that many lines of ``left`` may share: those are dealt to ``SALTS`` tasks."""
    dealt = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    return left.withColumn("_salt", salt).join(dealt, [*on, "_salt"], how).drop("_salt")


def scored(phrases: DataFrame, words: DataFrame, least: int, covered: int, scratch: Scratch) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates that no longer one covers."""
    single = words.filter(F.col("f") >= least).select("lang", F.col("word").alias("part"), "f")
    parts = single.unionAll(phrases.select("lang", F.col("phrase").alias("part"), "f"))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))

    def joined(start, size):
        return F.array_join(F.slice("w", start, size), " ")

    split = phrases.withColumn("w", F.split("phrase", " ")).withColumnRenamed("f", "a")
    cuts = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("first"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest")
    )
    left = parts.select("lang", F.col("part").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    counted = _join(_join(_join(cuts, left, ["lang", "first"]), right, ["lang", "rest"]), totals, ["lang"])
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    lines = counted.withColumn("above", F.lit(1000).cast("decimal(4,0)") * exact["a"] * exact["n"]).withColumn("below", exact["l"] * exact["r"])
    lowest = lines.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("cut"))

    inside = (
        split.filter("size > 2")
        .withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
        .withColumn("s", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
        .select("lang", joined(F.col("s"), F.col("m")).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    kept = lowest.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def ranked(candidates: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of every language; parts of a language are cut to as many lines first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = candidates.withColumn("_part", part).withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    best = first.filter(F.col("_rank") <= most).withColumn("rank", rank).filter(F.col("rank") <= most)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
