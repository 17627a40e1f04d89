"""Operators for preparing training text: one module per operator, plus the
registered queries (``queries``) and their SQL (``sql``).

Nothing outside this subpackage imports it.
"""
