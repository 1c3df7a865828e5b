from gapwise.sources.delimited import (
    CENSUS_CATEGORICAL,
    CENSUS_LABEL,
    CENSUS_NUMERIC,
    CENSUS_SCHEMA,
    read_delimited,
)

__all__ = ["CENSUS_CATEGORICAL", "CENSUS_LABEL", "CENSUS_NUMERIC", "CENSUS_SCHEMA", "read_delimited"]
