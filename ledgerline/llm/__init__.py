"""Operators for preparing text corpora: extraction, fingerprints, search,
personal data, language, toxicity, near duplicates, mixing, packing and URL
filters. Nothing else in the library imports this subpackage."""
