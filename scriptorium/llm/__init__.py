"""Training-data operators: deduplication, decontamination, scoring, extraction and packing."""
