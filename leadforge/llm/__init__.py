"""Training-data operators: search, token files, packing, near duplicates,
tokenisation, language ID, fingerprints, line dedup, chat formatting, counts.

One module per operator; ``queries`` registers them.  Nothing outside this
folder (but for ``corpus_pipeline.py``) imports it.
"""
