"""Training-data operators for large text corpora, independent of the rest of the library."""
