"""billflow: a PySpark library for billing work-queue data.

Every public operator is a plain ``DataFrame -> DataFrame`` function built from
Spark's own expressions, joins, aggregates and windows.
"""

from billflow.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
