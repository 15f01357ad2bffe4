"""Operators for preparing training text at scale.

Nothing outside this package, ``corpus_pipeline.py`` and the guarded import in
``__spark_entry__.py`` depends on it.  ``queries.py`` holds the registered
queries, ``oracle_sql.py`` their SQL where SQL can express them.
"""
