"""Operators for preparing large text corpora: licence scans, token output,
quality rules and classifiers, near-duplicates, decontamination, mixing,
HTML extraction and web archives.  Nothing outside this subpackage (and
``corpus_pipeline.py``) imports it."""
