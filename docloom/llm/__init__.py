"""Training-data operators: one module per operator, plus ``queries`` (the thin registered queries).

Nothing outside this subpackage imports it.
"""
