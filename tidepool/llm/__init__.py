"""Operators of a training-data pipeline and their registered queries.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds the
queries of :mod:`tidepool.llm.queries` when the folder is present.
"""
