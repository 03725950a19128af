"""Operators for preparing training text: deduplication, quality, privacy,
tokenization and packing.

Each module holds one operator with a general interface over any frame with
an id and a text column. ``queries`` applies them to the ``documents`` table.
"""
