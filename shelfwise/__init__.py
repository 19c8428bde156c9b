"""shelfwise: retail analytics and table ingest as Spark DataFrame pipelines.

Every public function takes DataFrames (or a SparkSession plus paths) and
returns a DataFrame built from Spark's own DataFrame, SQL and Structured
Streaming operators.  Nothing is collected to the driver except bounded values: a
min/max pair, a last-seen key, and tables of at most one row per column, split,
key range, heavy key or file.
"""

from shelfwise.session import build_session, scratch_path, session_conf, session_time_zone

__all__ = ["build_session", "scratch_path", "session_conf", "session_time_zone"]
