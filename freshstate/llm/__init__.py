"""Training-data operators: ten text-corpus operators, each a Spark job.

Nothing else in the library imports this subpackage. ``queries`` holds the
registered queries and their SQL.
"""
