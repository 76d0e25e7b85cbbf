"""Operators for preparing training data for language models.

Nothing else in the library imports this subpackage.  The functions that run in
tasks are imported there, so a cluster ships the package to its executors
(``--py-files``) as with any PySpark job that has modules of its own.
"""
