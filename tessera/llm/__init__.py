"""Operators for preparing large text corpora.

Each module holds one operator with its general interface; ``queries`` applies
them to the test tables and ``oracle`` has the SQL for those that SQL can
express. Nothing else in the library imports this subpackage.
"""
