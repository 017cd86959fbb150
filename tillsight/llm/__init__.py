"""Training-data operators (quality, near copies, decontamination, PII, packing, formats).

Nothing else in the library imports this subpackage; ``queries.py`` registers one query per operator.
"""
