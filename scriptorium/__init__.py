"""Spark-native engine for versioned documentation corpora: ingest, normalise, index and search as DataFrame plans."""
