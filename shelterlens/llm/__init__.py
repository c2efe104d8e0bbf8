"""Training-data operators (deduplication, scoring, formatting, packing) over Spark tables."""
