"""gapwise: feature preparation and missing-aware boosted classification on Spark DataFrames."""
