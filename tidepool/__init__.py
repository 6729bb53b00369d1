"""tidepool: open-data lake operators on PySpark.

Every operator takes and returns DataFrames and stays lazy; only the
sinks in :mod:`tidepool.operators.load` and :mod:`tidepool.streaming`
trigger work.
"""

from tidepool.session import build_session, checkpoint_root, prepare

__all__ = ["build_session", "checkpoint_root", "prepare"]
