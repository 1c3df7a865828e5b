"""Spark's own boosted trees, for features without missing values."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier


def plain_boosted_trees(
    maxDepth: int = 3, maxIter: int = 100, stepSize: float = 0.3, seed: int = 123, **params
) -> GBTClassifier:
    """``GBTClassifier`` at the usual settings. It refuses NaN and reads absent entries as zero."""
    return GBTClassifier(maxDepth=maxDepth, maxIter=maxIter, stepSize=stepSize, seed=seed, **params)
