"""Trees as plain records, and the column expressions that walk them.

Nodes are numbered 1 at the root, 2n and 2n+1 below n. A split keeps its feature, the bin
and value it cuts at, the side for missing values and its gain; a leaf keeps its weight.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

@dataclass
class Tree:
    round: int
    label_class: int
    splits: dict[int, dict] = field(default_factory=dict)
    weights: dict[int, float] = field(default_factory=dict)

    @staticmethod
    def empty(round: int, label_class: int) -> "Tree":
        """A tree that moves no margin."""
        return Tree(round, label_class, {}, {1: 0.0})

    def as_dict(self) -> dict:
        return {
            "round": self.round,
            "class": self.label_class,
            "splits": {str(n): s for n, s in self.splits.items()},
            "weights": {str(n): w for n, w in self.weights.items()},
        }

    @staticmethod
    def from_dict(d: dict) -> "Tree":
        return Tree(
            d["round"],
            d["class"],
            {int(n): s for n, s in d["splits"].items()},
            {int(n): w for n, w in d["weights"].items()},
        )


def _list(values: list) -> str:
    return f"array({', '.join(str(v).lower() if isinstance(v, bool) else str(v) for v in values)})"


def descended(source: str, keep: list[str], trees: dict[str, Tree], depth: int) -> str:
    """SQL text for ``source`` with its columns ``keep`` and, for each tag of ``trees``, the node ``n<tag>`` at ``depth``.

    It reads the row's ``positions`` and ``bins``. A path that has ended goes on to the left. A level's
    splits enter as one constant array, feature, lowest and highest bin of the left side packed into
    one number each, which Spark hands to its generated code as data: the code is the same for
    every tree, so it is compiled once, and small enough to be compiled well.
    """
    columns = ", ".join(keep)
    # the root's number comes from a column, or its split would be written into the code as a constant
    text = f"SELECT {columns}{''.join(f', 1 + 0 * y AS n{tag}' for tag in trees)} FROM {source}"
    for level in range(depth):
        moved = []
        for tag, tree in trees.items():
            codes = [_packed(tree.splits.get(n)) for n in range(2**level, 2 ** (level + 1))]
            code = f"get({_list([f'{c}L' for c in codes])}, n{tag} - {2**level})"
            feature = f"CAST(shiftright({code}, 32) AS INT)"
            entry = f"get(bins, if(positions IS NULL, {feature} + 1, CAST(array_position(positions, {feature}) AS INT) - 1))"  # null where absent
            place = f"coalesce({entry}, -1S) + 1"
            moved.append(f"2 * n{tag} + if({place} >= (shiftright({code}, 16) & 65535) AND {place} <= ({code} & 65535), 0, 1) AS n{tag}")
        text = f"SELECT {columns}, {', '.join(moved)} FROM ({text})"
    return text


def _packed(split: dict | None) -> int:
    """Feature, and the lowest and highest bin plus 1 that go left; all of them where there is no split."""
    if split is None:
        return 65535
    return (split["feature"] << 32) | ((0 if split["default_left"] else 1) << 16) | (split["bin"] + 1)


def among(nodes: set[int], depth: int, tag: str) -> str:
    """SQL test for rows whose node at ``depth`` is one of ``nodes``."""
    wanted = [n in nodes for n in range(2**depth, 2 ** (depth + 1))]
    return f"get({_list(wanted)}, n{tag} - {2**depth})"


def weight_at(tree: Tree, depth: int, tag: str) -> str:
    """SQL text for the weight of a row that has gone down to ``depth``."""
    weights = []
    for n in range(2**depth, 2 ** (depth + 1)):
        while n not in tree.weights:
            n //= 2
        weights.append(f"{tree.weights[n]!r}D")
    return f"get({_list(weights)}, n{tag} - {2**depth})"


def margin_columns(trees: list[Tree], values: dict[int, Column]) -> dict[int, Column]:
    """The sum of weights per modelled class, added up over Arrow batches of the feature columns.

    One way for forests of any size: as one column expression a forest of the usual hundred
    trees outgrows what the JVM compiles and runs some 40 times slower.
    """
    classes = sorted({t.label_class for t in trees})
    used = sorted({s["feature"] for t in trees for s in t.splits.values()})
    if not used:  # no tree has a split
        return {c: F.lit(sum(t.weights[1] for t in trees if t.label_class == c)) for c in classes}
    batch = _margin_batches(trees, classes, {f: i for i, f in enumerate(used)})
    listed = batch(*[values[f] for f in used])
    return {c: F.get(listed, F.lit(i)) for i, c in enumerate(classes)}


def _margin_batches(trees: list[Tree], classes: list[int], place: dict[int, int]):
    def weight(tree: Tree, node: int, x: list[np.ndarray]):
        split = tree.splits.get(node)
        if split is None:
            return tree.weights[node]
        value, cut = x[place[split["feature"]]], split["threshold"]
        if cut is None:
            left = split["default_left"] | ~np.isnan(value)
        else:
            left = ~(value >= cut) if split["default_left"] else value < cut
        return np.where(left, weight(tree, 2 * node, x), weight(tree, 2 * node + 1, x))

    @F.arrow_udf(ArrayType(DoubleType()))
    def margins(*columns: pa.Array) -> pa.Array:
        x = [c.to_numpy(zero_copy_only=False) for c in columns]
        sums = np.zeros((len(x[0]), len(classes)))
        for tree in trees:
            sums[:, classes.index(tree.label_class)] += weight(tree, 1, x)
        starts = np.arange(len(x[0]) + 1, dtype=np.int32) * len(classes)
        return pa.ListArray.from_arrays(starts, sums.ravel())

    return margins
