"""Training-data operators: decontamination, near-dedup, language id, BPE, chat packing,
toxicity, URL rules, repeated-substring removal, token counts, exact top-k search, hard
negatives, centroid clustering and license notices.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
