from gapwise.operators.boost.classifier import BoostedTreeClassifier, BoostedTreeModel
from gapwise.operators.boost.features import bin_columns, entry_arrays, feature_columns
from gapwise.operators.boost.plain import plain_boosted_trees
from gapwise.operators.boost.splits import best_splits, gradient_histogram, split_candidates

__all__ = [
    "BoostedTreeClassifier",
    "BoostedTreeModel",
    "best_splits",
    "bin_columns",
    "entry_arrays",
    "feature_columns",
    "gradient_histogram",
    "plain_boosted_trees",
    "split_candidates",
]
