"""MinHash near-duplicates of texts, by a multi-index Hamming join.

A document's set holds the hashes of its distinct runs of ``shingle`` words (a shorter
document: its whole word sequence). Each of ``chunks * chunk_len`` minima over the set is
cut to 8 bits. Two signatures that differ in at most ``chunks * (errors + 1) - 1`` places
have, by the pigeonhole principle, a chunk that differs in at most ``errors`` places; so
every chunk is indexed once for each choice of ``errors`` places left out, and such a pair
meets in at least one bucket. Pairs further apart may meet too and are then checked as well.

How buckets are worked off without emitting all their pairs:

1. Documents of equal sets become one class, represented by its smallest id.
2. Every member of a bucket is checked against the bucket's smallest id, exactly, on sets.
3. Components are formed. A bucket within one component has nothing left to find.
4. In buckets that hold several components, rows beside the largest one are joined with all rows.
   The join itself asks for different components, for the signature-distance threshold, for the
   first bucket in which a pair meets and for two bounds on the overlap, from parities and from
   16-bit forms of the sets, which never rule out a link. So what comes out of it is hardly more
   than links, and these are checked exactly.
   No pair that meets in a bucket and could join two components is left out, unless its
   signatures differ in more than ``distance`` places.

Defined results: null, blank and wordless texts have an empty set and are linked with
nothing; rows without an id are their own component (null); repeated rows stay repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.llm.common import LOWER, encoded, mix, window_hashes, word_hashes
from gapwise.llm.components import components
from gapwise.scratch import Scratch

#: Shingles that are hashed together, which bounds a task's memory besides the largest document.
GROUP_SHINGLES = 1 << 18
#: Bits of one bitmap of Spark's; for each wanted id; and at most in all (32 MB in each executor).
BITMAP, BITS_PER_ID, MOST_BITS = 1 << 15, 64, 1 << 28
#: Bits of a set's parities, as 64-bit numbers; 1,024 tell sets of up to about 1,200 items apart.
PARITY_BITS = 1 << 10


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    if not text:
        return np.empty(0, np.uint64)
    words = word_hashes(encoded(text).translate(LOWER))
    if 0 < len(words) < size:
        return window_hashes(words, len(words))
    return np.unique(window_hashes(words, size))


def signatures(sets: list[np.ndarray], length: int) -> np.ndarray:
    """8-bit minima of non-empty sets: one row for each set."""
    values = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    factors = mix(np.arange(1, length + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.empty((len(sets), length), np.uint8)
    for k, factor in enumerate(factors):
        out[:, k] = mix(np.minimum.reduceat(values * factor, starts)) & np.uint64(255)
    return out


def parities(items: np.ndarray) -> np.ndarray:
    """A bit for each of ``PARITY_BITS`` parts of the hashes: whether the set has an odd number of items there.

    Two sets' bits differ in no more places than there are items in one of the sets alone.
    """
    odd = np.bincount((items >> np.uint64(65 - PARITY_BITS.bit_length())).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def bucket_keys(signature: np.ndarray, chunks: int, chunk_len: int, errors: int) -> np.ndarray:
    """One row of keys for each signature: every chunk with every choice of ``errors`` places left out."""
    keys = []
    for c in range(chunks):
        part = signature[:, c * chunk_len : (c + 1) * chunk_len].astype(np.uint64)
        for out in combinations(range(chunk_len), errors):
            key = np.full(len(signature), len(keys) + 1, np.uint64)
            for place in range(chunk_len):
                if place not in out:
                    key = mix(key * np.uint64(257) + part[:, place])
            keys.append(key)
    return np.stack(keys, axis=1)


def _signed(df: DataFrame, shingle: int, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(ids, sets):
            sizes = np.array([len(s) for s in sets], np.int64)
            full = [s for s in sets if len(s)]
            rows: list = [None] * len(sets)
            if full:
                drawn = iter(signatures(full, length))
                rows = [next(drawn).tobytes() if n else None for n in sizes]
            first = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            second = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes), pa.array(first), pa.array(second), pa.array(rows, pa.binary())],
                names=["id", "n_shingles", "set_a", "set_b", "signature"],
            )

        for batch in batches:
            ids, sets, held = [], [], 0
            for i, text in zip(batch.column(0), batch.column(1)):
                ids.append(i.as_py())
                sets.append(shingles(text.as_py(), shingle))
                held += len(sets[-1])
                if held >= GROUP_SHINGLES:
                    yield flush(ids, sets)
                    ids, sets, held = [], [], 0
            if ids:
                yield flush(ids, sets)

    return df.mapInArrow(run, "id long, n_shingles long, set_a long, set_b long, signature binary")


def _keyed(classes: DataFrame, chunks: int, chunk_len: int, errors: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            signature = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(len(ids), -1)
            for at in range(0, len(ids), 4096):
                keys = bucket_keys(signature[at : at + 4096], chunks, chunk_len, errors)
                slots = np.tile(np.arange(keys.shape[1], dtype=np.int32), len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(ids[at : at + 4096], keys.shape[1])), pa.array(slots)],
                    names=["key", "id", "slot"],
                )

    return classes.select("id", "signature").mapInArrow(run, "key long, id long, slot int")


def _perhaps_among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is one of ``ids``, and about one in ``BITS_PER_ID`` others; no row is shuffled.

    The ids' hashes are marked in a bitmap, of which every executor gets a copy; where it has ``MOST_BITS``
    and there are more ids than suit it, more other rows come through.
    """
    bits = min(max(BITMAP, 1 << (BITS_PER_ID * ids.count()).bit_length()), MOST_BITS)
    place = F.pmod(F.xxhash64("id"), F.lit(bits))
    split = {"_part": F.floor(place / BITMAP), "_bit": F.pmod(place, F.lit(BITMAP))}
    marked = ids.select(*[c.alias(name) for name, c in split.items()]).groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_marks"))
    byte = F.conv(F.hex(F.substring("_marks", F.shiftright("_bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = docs.withColumns(split).join(F.broadcast(marked), "_part")
    return found.filter(F.getbit(byte, F.pmod("_bit", F.lit(8)).cast("int")) == 1).select(*docs.columns)


def _sets_of(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """``id, items, odd``: the set of each of ``ids`` and its parities. Texts stay where they are read; only sets are shuffled."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(t, shingle) for t in part.column(1).to_pylist()]
                numbers = [pa.array(x, pa.list_(pa.int64())) for x in ([s.view(np.int64) for s in sets], [parities(s) for s in sets])]
                yield pa.RecordBatch.from_arrays([part.column(0), *numbers], names=["id", "items", "odd"])

    # repeated ids carry one set each; the smallest of equal-id texts stands for the id's class
    found = _perhaps_among(docs.select("id", "text"), ids).mapInArrow(run, "id long, items array<long>, odd array<long>")
    return found.dropDuplicates(["id"]).join(ids, "id", "left_semi")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough: 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("u"), F.col("items").alias("a"))
    right = sets.select(F.col("id").alias("v"), F.col("items").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return (
        pairs.join(left, "u")
        .join(right, "v")
        .filter(100 * both >= percent * (F.size("a") + F.size("b") - both))
        .select("u", "v")
    )


def _packed(chunks: int, chunk_len: int) -> list[Column]:
    """A signature as one long number for each chunk; a chunk has at most 7 minima."""
    return [F.conv(F.hex(F.substring("signature", c * chunk_len + 1, chunk_len)), 16, 10).cast("long") for c in range(chunks)]


def _places_apart(a: str, b: str) -> Column:
    """In how many places two packed chunks differ: bytes of the exclusive-or that are not zero."""
    low, high = F.lit(0x7F7F7F7F7F7F7F).cast("long"), F.lit(0x80808080808080).cast("long")
    x = F.col(a).bitwiseXOR(F.col(b))
    return F.bit_count((x.bitwiseAND(low) + low).bitwiseOR(x).bitwiseAND(high))


def _open_rows(labelled: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components; ``beside``: not of the component that most of a bucket's rows have.

    labelled: key, slot, id, component.
    """
    parts = labelled.groupBy("key", "component").agg(F.count("*").alias("rows"))
    main = parts.groupBy("key").agg(F.max(F.struct("rows", "component")).alias("main"), F.count("*").alias("parts"))
    main = main.filter("parts > 1").select("key", F.col("main.component").alias("main"))
    return labelled.join(main, "key").select("key", "slot", "id", "component", (F.col("component") != F.col("main")).alias("beside"))


def _met_across(rows: DataFrame, sets: DataFrame, classes: DataFrame, chunks: int, chunk_len: int, errors: int, distance: int, percent: int) -> DataFrame:
    """Pairs (u, v) of different components in one bucket that may be links; rows: those of ``_open_rows``.

    Only rows ``beside`` the main component meet all rows of their bucket, so that no more than twice the
    pairs of different components are looked at, however large the main component is. No column of the
    condition is nullable: tests for null would make the join's method too long for the JVM to compile (8,000
    bytes), and each pair would take many times as long. Before two sets are compared, their parities are: no
    link differs in more of them than it may have items in one of its sets alone.
    """
    ways = comb(chunk_len, errors)
    packed, odd = [f"s{c}" for c in range(chunks)], [f"odd{k}" for k in range(PARITY_BITS // 64)]
    short = F.array_distinct(F.transform("items", lambda x: (x.bitwiseAND(F.lit(0xFFFF)) - 32768).cast("short")))
    full = (
        rows.join(sets.select("id", F.size("items").alias("n"), short.alias("short"), *[F.col("odd")[k].alias(name) for k, name in enumerate(odd)]), "id")
        .join(classes.select("id", *[c.alias(name) for name, c in zip(packed, _packed(chunks, chunk_len))]), "id")
        .withColumns({"lost": F.col("n") - F.size("short"), "chunk": F.floor(F.col("slot") / ways).cast("int"), "way": F.col("slot") % ways})
    )
    never_null = {c: F.coalesce(c, F.lit(0)) for c in ("id", "component", "n", "lost", "chunk", "way", *packed, *odd)}
    never_null |= {"beside": F.coalesce("beside", F.lit(False)), "short": F.coalesce("short", F.array().cast("array<short>"))}

    def side(x: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.col("key").alias(f"{x}key"), *[c.alias(f"{x}{name}") for name, c in never_null.items()])

    apart = [_places_apart(f"a{c}", f"b{c}") for c in packed]
    # the first chunk in which the pair may meet, and there the first choice of places left out
    first = F.lit(True)
    for c in range(chunks):
        first = first & ((F.col("achunk") <= c) | (apart[c] > errors))
        first = first & ((F.col("achunk") != c) | (F.col("away") == 0) | (F.col(f"a{packed[c]}") != F.col(f"b{packed[c]}"))) if errors == 1 else first
    unlike = reduce(add, [F.bit_count(F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}"))) for k in odd])
    most = F.size(F.array_intersect("ashort", "bshort")) + F.least("alost", "blost")
    fits = (
        (F.col("acomponent") != F.col("bcomponent"))
        & (~F.col("abeside") | (F.col("aid") > F.col("bid")))
        & (100 * F.least("an", "bn") >= percent * F.greatest("an", "bn"))
        & (reduce(add, apart) <= distance)
        & first
        & ((100 + percent) * unlike <= (100 - percent) * (F.col("an") + F.col("bn")))
        & ((100 + percent) * most >= percent * (F.col("an") + F.col("bn")))
    )
    met = side("a", full).join(side("b", full.filter("beside")), (F.col("akey") == F.col("bkey")) & fits)
    return met.select(F.greatest("aid", "bid").alias("u"), F.least("aid", "bid").alias("v")).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    chunks: int = 10,
    chunk_len: int = 7,
    errors: int = 1,
    distance: int = 27,
) -> DataFrame:
    """One row for each document: id, n_shingles, component_id, kept.

    Documents are linked if their sets' Jaccard similarity is at least ``percent`` / 100.
    ``component_id`` is the smallest id reachable by links; a document is kept if it is that.
    Longer chunks suit larger corpora: they make chance meetings rarer and need more chunks
    for the same recall. At similarity 0.8 a pair misses all buckets of the defaults with a
    probability of 0.0002, and lies beyond ``distance`` with one of 0.00003. Ids need to be integers; of several texts under one id the
    smallest id of each text's class counts.
    """
    if chunk_len > 7:
        raise ValueError("a chunk has at most 7 minima")
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed, _ = scratch.write(_signed(docs, shingle, chunks * chunk_len))
    named = signed.filter("id IS NOT NULL AND n_shingles > 0")
    group = ["n_shingles", "set_a", "set_b"]
    classes, _ = scratch.write(named.groupBy(*group).agg(F.min_by("signature", "id").alias("signature"), F.min("id").alias("id")))

    keyed = _keyed(classes, chunks, chunk_len, errors)
    hubs = keyed.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).filter("hub < last").select("key", "hub")
    met, _ = scratch.write_narrow(keyed.join(hubs, "key"))

    first, _ = scratch.write_narrow(met.filter("id > hub").select(F.col("id").alias("u"), F.col("hub").alias("v")).distinct())
    members, _ = scratch.write_narrow(first.select(F.col("u").alias("id")).union(first.select(F.col("v").alias("id"))).distinct())
    sets, _ = scratch.write(_sets_of(docs.filter("id IS NOT NULL"), members, shingle))
    linked, _ = scratch.write(_confirmed(first, sets, percent))
    stars = components(linked, scratch)

    labelled = met.join(stars, "id", "left").select("key", "slot", "id", F.coalesce("component", "id").alias("component"))
    open_rows, _ = scratch.write_narrow(_open_rows(labelled))
    across, _ = scratch.write(_met_across(open_rows, sets, classes, chunks, chunk_len, errors, distance, percent))
    more, _ = scratch.write(_confirmed(across, sets, percent))
    if not more.isEmpty():
        stars = components(linked.union(more), scratch)

    of_class = classes.join(stars, "id", "left").select(*group, F.coalesce("component", "id").alias("found"))
    out = signed.join(of_class, group, "left")
    component = F.when(F.col("id").isNull() | (F.col("n_shingles") == 0), F.col("id")).otherwise(F.col("found"))
    return out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
