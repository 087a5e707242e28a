"""Training-data operators: deduplication, decontamination, language models, packing.

Nothing outside this subpackage imports it.
"""
