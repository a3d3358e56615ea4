"""Operators for preparing training text at scale, one module each.

Nothing outside this package imports it; ``queries.QUERIES`` and
``oracle.statements`` are picked up by the entry module when present.
"""
