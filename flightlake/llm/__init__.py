"""Training-data operators: near-dedup, mixing, licence scans, token counts, sharding,
quality scoring, personal-data surrogates, secret scans, decontamination, nearest neighbours,
whitening, language identification, periodic runs.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
