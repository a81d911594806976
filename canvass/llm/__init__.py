"""Operators for preparing training text at scale, and the pipeline over them.

Every operator is a ``DataFrame -> DataFrame`` function that selects the
columns it is told to use, so extra columns (whatever their names) pass by.
Nothing else in the library imports this subpackage.
"""
