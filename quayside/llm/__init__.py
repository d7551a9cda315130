"""Training-data operators: fingerprints, language mixtures, tokenisation,
binary records, personal data, near duplicates, page text, secrets, repeated
passages and benchmark decontamination.

Nothing outside this folder imports it; `registry.py` lists its queries.
"""
