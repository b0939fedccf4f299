"""Training-data operators: text models, deduplication, mixing, packing, archives.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; ``queries`` derives the registered
``opN_*`` results from them.
"""
