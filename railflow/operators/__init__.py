"""Relational operators of the pipeline: fold, merge, name resolution,
surrogate keys, star schema, graph searches, nearest station, sinks."""
