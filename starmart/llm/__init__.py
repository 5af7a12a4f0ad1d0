"""Training-data operators: extraction, dedup, language ID, mixing, scoring, token output.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` derives the registered results.
"""
