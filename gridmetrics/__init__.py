"""gridmetrics: electricity-market time-series analytics on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
Spark SQL expressions; see ``operators``, ``sources``, ``functions``,
``plans`` and ``streaming``.
"""

from .session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
