"""Tile-level population and household estimation, and ping enrichment, on Spark DataFrames."""
