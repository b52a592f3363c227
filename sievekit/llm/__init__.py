"""Training-data operators: secret scans, n-gram joins, quality and toxicity
scores, chat formatting, URL filters, packing, language ID, document
fingerprints and benchmark decontamination.

Nothing else in the library imports this subpackage."""
