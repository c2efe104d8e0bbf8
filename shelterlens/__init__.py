"""Monthly cohort, incidence and dwell-time reports as lazy Spark DataFrame operators.

Every public operator maps DataFrames to a DataFrame, covers all report months of
a run in one plan, and uses built-in Spark expressions only.
"""

from shelterlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
