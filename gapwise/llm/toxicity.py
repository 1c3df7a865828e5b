"""Toxicity by multiple-instance learning: a document is a bag of sentences.

Words and the beginnings of words (their first 4, 5 and 6 letters, written ``abcd*``) are the
features. A sentence holding the known features W has the probability sigmoid(bias + sum of
their weights), less what a sentence without any has; a document's score combines its
sentences by noisy-or, 1 - prod(1 - p). Weights are learned from document labels alone, and
the fitted model names the sentences that carry a score.

Fitting uses a bounded sample of labelled rows: about ``sample_rows`` of each label, drawn
by hash among the ids, one text of each id, whole whatever its length. An id with both labels counts as 0,
one with several texts is learned from the least of them. Candidate features are those whose
document frequency differs between the labels by ``least_z`` standard errors, at most
``vocabulary`` of them. Scoring covers every whole text.

Defined results: null, blank and wordless texts score 0; rows without a label are only
scored; without both labels in the sample the model is empty and every score is 0.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = re.compile(r"\w+")
SENTENCE = re.compile(r"[^.!?\n]+")
PREFIXES = (4, 5, 6)
RESULT = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "offending",
            T.ArrayType(
                T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
            ),
        ),
    ]
)
ARROW_RESULT = pa.struct(
    [("score", pa.float64()), ("offending", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))]
)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


@dataclass
class ToxicityModel:
    """Word weights and the bias of a sentence."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0

    def features(self, text: str) -> set[str]:
        """The known features of a text."""
        words = set(WORDS.findall(text.lower()))
        found = self.weights.keys() & words
        for n in PREFIXES:
            found |= self.weights.keys() & {w[:n] + "*" for w in words if len(w) > n}
        return found

    def known(self, text: str | None) -> list[tuple[int, int, set[str]]]:
        """The sentences that hold known words: start, end, words."""
        if not text or not self.features(text):
            return []
        out = []
        for m in SENTENCE.finditer(text):
            words = self.features(m.group())
            if words:
                out.append((m.start(), m.end(), words))
        return out

    def sentence(self, words: set[str]) -> float:
        ground = _sigmoid(self.bias)
        total = sum(self.weights[w] for w in sorted(words))
        return float(max(0.0, _sigmoid(self.bias + total) - ground) / (1 - ground))

    def explain(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """A document's score and its sentences that score at least a half of what rejects a document."""
        clean, offending = 1.0, []
        for start, end, words in self.known(text):
            p = self.sentence(words)
            clean *= 1 - p
            if p >= 0.25:
                offending.append((start, end, p))
        return 1 - clean, offending


def scored(docs: DataFrame, model: ToxicityModel, text_col: str = "text", output_col: str = "toxicity") -> DataFrame:
    """``docs`` with a struct column: score, and offending sentences by their code points."""

    def run(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            score, found = model.explain(t.as_py())
            rows.append({"score": score, "offending": [{"start": a, "end": b, "score": p} for a, b, p in found]})
        return pa.array(rows, ARROW_RESULT)

    return docs.withColumn(output_col, F.arrow_udf(run, RESULT)(F.col(text_col)))


def _train(bags: list[list[list[int]]], labels: np.ndarray, n_words: int, bias: float, steps: int, rate: float, l1: float) -> np.ndarray:
    """Word weights by proximal Adam on the noisy-or likelihood; every label has equal weight in sum."""
    doc_of, word_of, sentence_of, sentence_doc = [], [], [], []
    for d, bag in enumerate(bags):
        for words in bag:
            sentence_doc.append(d)
            word_of.extend(words)
            sentence_of.extend([len(sentence_doc) - 1] * len(words))
    word_of, sentence_of = np.array(word_of, np.int64), np.array(sentence_of, np.int64)
    sentence_doc = np.array(sentence_doc, np.int64)
    doc_weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    w, m, v = np.zeros(n_words), np.zeros(n_words), np.zeros(n_words)
    ground = _sigmoid(bias)
    if not len(word_of):
        return w
    for step in range(1, steps + 1):
        s = _sigmoid(bias + np.bincount(sentence_of, w[word_of], len(sentence_doc)))
        # while learning, the ground probability stays in, so that unknown words can gain weight
        log_clean = np.bincount(sentence_doc, np.log1p(-np.minimum(s, 1 - 1e-9)), len(labels))
        toxic = np.maximum(-np.expm1(log_clean), ground)
        # d(-log likelihood)/d(sum of weights of a sentence)
        outer = np.where(labels == 1, -(1 - toxic) / toxic, 1.0) * doc_weight
        slope = outer[sentence_doc] * s
        g = np.bincount(word_of, slope[sentence_of], n_words)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        size = rate / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        w = w - size * m / (1 - 0.9**step)
        w = np.sign(w) * np.maximum(np.abs(w) - np.minimum(size, 1e4) * l1, 0)
    return w


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = 4000,
    vocabulary: int = 4000,
    least_z: float = 4.0,
    least_weight: float = 1.5,
    steps: int = 120,
) -> ToxicityModel:
    """Learn from texts and the labels of their ids.

    The sample is drawn among the labels, before any text is read: about ``sample_rows`` ids of
    each label. So few ids may be broadcast, whatever the size of the corpus.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return ToxicityModel()
    part = F.when(F.col("label") == 1, F.lit(sample_rows / totals[1])).otherwise(F.lit(sample_rows / totals[0]))
    drawn = known.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col("id").cast("string")), F.lit(1_000_000)) < part * 1_000_000)
    texts = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(drawn), "id").groupBy("id").agg(F.min("text").alias("text"), F.min("label").alias("label")).select("text", "label").cache()
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        sample.unpersist()
        return ToxicityModel()
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\w+"), F.lit(0)))
    begun = [
        F.array_distinct(F.transform(F.filter(words, lambda w, n=n: F.length(w) > n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*"))))
        for n in PREFIXES
    ]
    words = sample.select("label", F.explode(F.concat(words, *begun)).alias("word"))
    counts = words.groupBy("word").agg(F.sum("label").alias("d1"), F.sum(1 - F.col("label")).alias("d0")).filter("d1 + d0 >= 3")
    p = (F.col("d1") + F.col("d0")) / F.lit(float(n1 + n0))
    error = F.sqrt(p * (1 - p) * F.lit(1.0 / n1 + 1.0 / n0)) + 1e-12
    z = F.abs(F.col("d1") / F.lit(float(n1)) - F.col("d0") / F.lit(float(n0))) / error
    known = [r["word"] for r in counts.select("word", z.alias("z")).filter(F.col("z") >= least_z).orderBy(F.desc("z"), "word").limit(vocabulary).collect()]
    index = {word: k for k, word in enumerate(known)}
    probe = ToxicityModel(weights=dict.fromkeys(known, 0.0))

    def bag(texts: pa.Array) -> pa.Array:
        return pa.array([[sorted(index[w] for w in words) for _, _, words in probe.known(t.as_py())] for t in texts], pa.list_(pa.list_(pa.int32())))

    gathered = sample.select("label", F.arrow_udf(bag, "array<array<int>>")(F.col("text")).alias("bag")).toArrow()
    sample.unpersist()
    order = sorted(zip(gathered["label"].to_pylist(), gathered["bag"].to_pylist()), key=repr)
    weights = _train([b for _, b in order], np.array([y for y, _ in order]), len(known), -4.0, steps, 0.25, 2e-5)
    return ToxicityModel(weights={word: float(weights[k]) for word, k in index.items() if abs(weights[k]) >= least_weight})


def training_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The labels without the fifth of the ids that their checksum holds out."""
    return labels.filter(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) != 0)
