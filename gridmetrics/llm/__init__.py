"""Training-data operators: one module per operator, thin queries in ``queries``.

Nothing outside this subpackage imports it; it uses only the general helpers
of ``gridmetrics.session``.
"""
