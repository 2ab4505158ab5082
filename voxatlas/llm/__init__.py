"""Text-corpus operators for preparing training data.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; ``queries`` holds the registered queries over the tables.
"""
