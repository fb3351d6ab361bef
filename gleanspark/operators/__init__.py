"""Whole-relation steps: links, fetches, robots, traversal, deduplication, batches, logs."""
