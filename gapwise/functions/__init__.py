from gapwise.functions.keys import md5_bucket, md5_uniform
from gapwise.functions.missing import (
    enforce,
    fill_constant,
    fill_normal,
    is_missing,
    missing_profile,
    nudge_zero,
    present_or_null,
    zero_when,
)
from gapwise.functions.vectors import (
    dense_array,
    has_absent,
    sparse_struct,
    to_dense,
    to_sparse_vector,
    vector_element,
    vector_parts,
)

__all__ = [
    "dense_array",
    "enforce",
    "fill_constant",
    "fill_normal",
    "has_absent",
    "is_missing",
    "md5_bucket",
    "md5_uniform",
    "missing_profile",
    "nudge_zero",
    "present_or_null",
    "sparse_struct",
    "to_dense",
    "to_sparse_vector",
    "vector_element",
    "vector_parts",
    "zero_when",
]
