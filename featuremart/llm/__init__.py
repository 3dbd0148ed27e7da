"""Operators of a training-data pipeline: token counts, language modelling,
personal data, decontamination, quality, near-duplicates, language ids,
repeated passages, vector search and byte-level BPE.

Nothing else in the library imports this package; ``queries`` registers one
``opN_<name>`` query per operator.
"""
