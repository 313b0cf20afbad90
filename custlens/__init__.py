"""custlens: customer feature and scoring engine on Spark DataFrames."""

__version__ = "0.1.0"
