"""Training-data operators: packing, filtering, deduplication, mixing, sharding and formatting of text corpora."""
