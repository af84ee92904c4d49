"""lakeledger: sharded export to a Parquet lake, reconciliation and run-log
analytics, written as DataFrame-to-DataFrame functions on PySpark."""

from lakeledger.session import build_session, new_run_dir, shared_dir

__all__ = ["build_session", "new_run_dir", "shared_dir"]
