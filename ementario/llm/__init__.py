"""Training-data operators: filters, deduplication, formatting, packing and token files."""
