"""tablevault: copies and syncs of tables, written as Spark DataFrame jobs."""

from tablevault.session import build_session, shared_root

__all__ = ["build_session", "shared_root"]
