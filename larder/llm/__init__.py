"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface and the thin ``opN_<name>`` query over
the whole intended table; ``registry`` gathers the queries.
"""
