"""Training-data operators on Spark: fingerprints, near and exact de-duplication, toxicity,
licence scans, source mixing, pseudonyms, byte-level BPE, language identification and
language-model scoring.

Nothing else in the library imports this subpackage.  Each operator module takes a
DataFrame with at least the columns it names and keeps its own general interface;
``queries`` holds the thin registered queries over the ``documents`` table.
"""
