"""Training-data operators. Nothing outside this package, its tests and corpus_pipeline imports it."""
