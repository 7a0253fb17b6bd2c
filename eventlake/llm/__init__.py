"""Training-data operators: near duplicates, chat formatting, personal data, tokenisation,
toxicity, packing, token files, quality and line rules.  Nothing outside this package (and
``corpus_pipeline.py``) imports it."""
