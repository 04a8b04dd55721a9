"""ledgerlens — transaction analytics and data quality as lazy Spark plans.

Every public operator takes and returns a ``DataFrame`` (or a ``Column``
for row functions); nothing runs until the caller triggers an action.
"""

from ledgerlens.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
