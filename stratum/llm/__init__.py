"""Operators for large-scale training-data pipelines (one module per operator).

Nothing outside this subpackage imports it; ``registry`` holds its driver queries and SQL.
"""
