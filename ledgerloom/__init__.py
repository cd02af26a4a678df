"""ledgerloom: messy extracts in, star schemas and business reports out, on Spark DataFrames."""

__version__ = "0.1.0"
