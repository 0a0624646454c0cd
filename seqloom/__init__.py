"""seqloom: training-corpus sequencing and training-metric analysis on Spark DataFrames."""

from seqloom.options import RunOptions

__all__ = ["RunOptions"]
