"""Training-data operators on PySpark: language id, decontamination, near-dedup,
license and secret scans, toxicity, token files, paragraph dedup, fingerprints
and source mixing.  Nothing else in the library imports this subpackage."""
