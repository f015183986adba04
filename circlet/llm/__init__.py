"""Training-data operators: deduplication, classifiers, tokenisation, packing, web archives, fingerprints."""
