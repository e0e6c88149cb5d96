"""Training-data operators: deduplication, scoring, filtering, sharding and packing of texts.

Every module holds one operator with its own interface; `registry` lists them as queries over the
driver tables. Nothing else in the library imports this subpackage.
"""
