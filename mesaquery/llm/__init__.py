"""Operators of a large-scale training-data pipeline.

Nothing outside this subpackage imports it; ``queries()`` and ``oracle_sql()`` in
``mesaquery.llm.registry`` hold the thin contract queries.
"""
