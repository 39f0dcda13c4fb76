"""Training-data operators: archives, scans, de-duplication, packing and token files.

Nothing else in the library imports this package.  Each module holds one
operator and its registered query; ``queries`` merges them.
"""
