"""Operators for training-data pipelines: tokens, markup, media, chat, privacy, duplicates and quality.

Nothing else in the library imports this subpackage.
"""
