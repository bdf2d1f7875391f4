"""quarry — curated instruction and chat data on Spark DataFrames.

Builders turn raw source tables into per-role records; operators order,
sample, split, render, encode, pack, validate and monitor them. Everything is
a DataFrame transformation planned by Catalyst.
"""

__version__ = "0.1.0"
