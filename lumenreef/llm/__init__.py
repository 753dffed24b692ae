"""Training-data operators: ten corpus-scale components over documents, pages and vectors.

Nothing else in the library imports this subpackage.
"""
