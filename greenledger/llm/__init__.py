"""Training-data operators: deduplication, decontamination, tokenization, packing, sharding, archives, toxicity.

Nothing else in the library imports this subpackage.
"""
