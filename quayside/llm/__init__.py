"""Training-data operators: extraction, cleaning, near-duplicates, tokens, shards and packing.

Nothing else in the library imports this subpackage.  ``queries.py`` holds the
registered queries; every operator keeps its own interface in its module.
"""
