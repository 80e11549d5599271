"""Training-data operators: text decontamination, licence scans, quality and
toxicity models, chat formatting, near-duplicate and repeated-passage removal,
nearest neighbours, packing and page extraction.

Nothing else in the library imports this subpackage.
"""
