"""Relational operators on the corpus tables: merge, near-duplicates, work queues, state transitions, retrieval."""
