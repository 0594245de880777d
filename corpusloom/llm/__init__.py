"""Operators for training-data pipelines: quality, language-model scores, near copies, decontamination, HTML text, tokens, URLs.

Nothing else in the library imports this subpackage. ``queries`` registers one query per operator.
"""
