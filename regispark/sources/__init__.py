"""Readers (typed delimited drops, encodings, archives, seeds) and sinks."""
