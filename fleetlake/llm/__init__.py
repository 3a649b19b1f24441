"""Operators for large-scale training-data pipelines.

Nothing outside this package imports it.  Every operator works on whole tables
and whole texts, keeps hot groups split or pre-aggregated, and writes
intermediate tables only below the shared folder named by the session.
"""
