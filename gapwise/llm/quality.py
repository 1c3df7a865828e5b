"""Quality rules: decision lists learned from labelled statistics.

Statistics of whole texts are plain numbers. From rows labelled good or bad, sequential
covering learns rules for *bad*: a conjunction of thresholds grows by information gain on one
part of the rows and is pruned from its end on the other; it is kept while it is nearly always
right on both parts, the rows it covers are set aside, and the next rule follows. The list is
emitted as one ordered Spark expression, CASE WHEN rule 1 THEN bad WHEN rule 2 ... ELSE good,
which reads like what a person would write.

Learning uses a bounded sample, about ``sample_rows`` rows of each label drawn by hash, of
statistics only. Defined results: null and empty texts have no words and zero statistics; no
rule is learned without both labels, and then all pass; null labels and statistics are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.llm.common import encoded, window_hashes, word_hashes

SYMBOLS = "#*$%&|<>"
WINDOW = 8
BLANKS = b" \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks", "n_digits", "n_distinct"]
#: What rules may test: shares and means, so that length alone decides little.
FEATURES = {
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(n_letters, 1)",
    "mark_share": "n_marks / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "n_words": "double(n_words)",
}


def _kinds() -> np.ndarray:
    """For each byte: 1 blank, 2 symbol, 4 upper-case ASCII, 8 letter (any byte beyond ASCII too), 16 mark, 32 digit, 64 continuation."""
    kinds = np.zeros(256, np.uint8)
    for b in range(256):
        c = chr(b)
        kinds[b] = (
            (b in BLANKS) * 1 | (c in SYMBOLS) * 2 | ("A" <= c <= "Z") * 4 | (c.isascii() and c.isalpha()) * 8 | (c in "!?.,;:") * 16 | (c.isdigit() and b < 128) * 32 | (128 <= b < 192) * 64
        )
    return kinds


KINDS = _kinds()


def text_counts(text: str | None) -> tuple[int, ...]:
    """The numbers of COUNTS for one text."""
    if not text:
        return (0,) * len(COUNTS)
    data = encoded(text)
    seen = np.bincount(KINDS[np.frombuffer(data, np.uint8)], minlength=128)
    of = lambda bit: int(sum(n for kind, n in enumerate(seen) if kind & bit))
    words = word_hashes(data)
    windows = window_hashes(words, WINDOW)
    repeated = 0
    if len(windows) > 1:
        order = np.argsort(windows, kind="stable")
        ordered = windows[order]
        same = ordered[1:] == ordered[:-1]
        if same.any():
            twice = np.zeros(len(windows), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            cover = np.zeros(len(words) + 1, np.int64)
            starts = np.flatnonzero(twice)
            cover[starts] += 1
            cover[starts + WINDOW] -= 1
            repeated = int((np.cumsum(cover)[:-1] > 0).sum())
    lines = [line for line in data.split(b"\n") if line.strip(BLANKS)]
    chars = len(data) - of(64)
    return (len(words), chars - of(1), of(2), len(lines) - len(set(lines)), repeated, len(lines), of(4), of(8), of(16), of(32), len(np.unique(words)))


def with_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts...) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [text_counts(value.as_py()) for value in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, pa.int64()) for c in zip(*rows)]], names=["id", *COUNTS])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


@dataclass(frozen=True)
class Test:
    """One threshold: feature <= or >= value."""

    feature: str
    below: bool
    value: float

    def holds(self, columns: dict[str, np.ndarray]) -> np.ndarray:
        return columns[self.feature] <= self.value if self.below else columns[self.feature] >= self.value

    def column(self) -> Column:
        x = F.expr(FEATURES[self.feature])
        return x <= self.value if self.below else x >= self.value

    def __str__(self) -> str:
        return f"{self.feature} {'<=' if self.below else '>='} {self.value:.6g}"


Rule = tuple[Test, ...]


def _holds(rule: Rule, columns: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for test in rule:
        out &= test.holds(columns)
    return out


def _best_test(columns: dict[str, np.ndarray], bad: np.ndarray, on: np.ndarray) -> tuple[float, Test | None]:
    """The threshold with the largest gain: covered bad rows times the bits they become surer."""
    p0, n0 = int(bad[on].sum()), int(on.sum())
    best, found = 0.0, None
    for name in FEATURES:
        x = columns[name][on]
        order = np.argsort(x, kind="stable")
        x, y = x[order], bad[on][order]
        cuts = np.flatnonzero(x[1:] > x[:-1])
        hits, total = np.cumsum(y)[cuts], cuts + 1
        for below, p, n in ((True, hits, total), (False, p0 - hits, n0 - total)):
            ok = p > 0
            if not ok.any():
                continue
            gain = np.where(ok, p * (np.log2(np.maximum(p, 1) / n) - np.log2(p0 / n0)), -1.0)
            k = int(np.argmax(gain))
            if gain[k] > best + 1e-9:
                best, found = float(gain[k]), Test(name, below, float((x[cuts[k]] + x[cuts[k] + 1]) / 2))
    return best, found


def learn(columns: dict[str, np.ndarray], bad: np.ndarray, grow: np.ndarray, most_rules: int, most_tests: int, least_precision: float, least_rows: int) -> list[Rule]:
    """Sequential covering: rules for bad rows, in order."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < most_rules and (bad & left & grow).sum() >= least_rows:
        rule: Rule = ()
        on = left & grow
        while len(rule) < most_tests and (~bad & on).any():
            _, test = _best_test(columns, bad, on)
            if test is None:
                break
            rule = (*rule, test)
            on = on & test.holds(columns)
        if not rule:
            break

        def worth(r: Rule) -> float:
            held = _holds(r, columns, len(bad)) & left & ~grow
            p, n = int((held & bad).sum()), int((held & ~bad).sum())
            return (p - 4 * n) / (p + n + 1)

        # pruning drops tests from the end while the other part of the rows does not get worse
        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        held = _holds(rule, columns, len(bad)) & left
        right, both = [int((held & bad & part).sum()) for part in (grow, ~grow)], [int((held & part).sum()) for part in (grow, ~grow)]
        if sum(right) < least_rows or any(r < least_precision * b for r, b in zip(right, both)):
            break
        rules.append(rule)
        left &= ~held
    return rules


def fit(
    labelled: DataFrame,
    label_col: str = "quality",
    order_col: str = "id",
    sample_rows: int = 10_000,
    most_rules: int = 12,
    most_tests: int = 4,
    least_precision: float = 0.97,
    least_rows: int = 5,
) -> list[Rule]:
    """Rules for label 0 from rows of COUNTS and a 0/1 label."""
    features = [F.expr(e).alias(name) for name, e in FEATURES.items() if name not in COUNTS] + [F.expr(FEATURES["n_words"]).alias("words")]
    rows = labelled.filter(F.col(label_col).isin(0, 1)).select(
        F.col(label_col).cast("int").alias("label"), F.pmod(F.xxhash64(F.lit("rules"), F.col(order_col).cast("string")), F.lit(1_000_000)).alias("h"), *features
    ).dropna()
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return []
    share = F.when(F.col("label") == 0, F.lit(sample_rows / totals[0])).otherwise(F.lit(sample_rows / totals[1]))
    sample = rows.filter(F.col("h") < share * 1_000_000).toPandas()  # bounded by sample_rows of each label
    sample = sample.sort_values(list(sample.columns)).reset_index(drop=True)
    columns = {name: sample["words" if name == "n_words" else name].to_numpy(np.float64) for name in FEATURES}
    return learn(columns, sample["label"].to_numpy() == 0, sample["h"].to_numpy() % 3 != 0, most_rules, most_tests, least_precision, least_rows)


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """(kept, rule): the ordered expression, and the first rule that held (null: none)."""
    kept, name = None, None
    for rule in rules:
        held = rule[0].column()
        for test in rule[1:]:
            held = held & test.column()
        text = F.lit(" AND ".join(map(str, rule)))
        kept = F.when(held, False) if kept is None else kept.when(held, False)
        name = F.when(held, text) if name is None else name.when(held, text)
    if kept is None:
        return F.lit(True), F.lit(None).cast("string")
    return kept.otherwise(True), name.otherwise(F.lit(None).cast("string"))


def base_failed(least_words: int = 20, most_repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeat_percent * F.col("n_words"))
