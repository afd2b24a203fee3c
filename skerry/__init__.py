"""skerry: composable PySpark operators for everyday data pipelines."""

from skerry.session import build_session, settle

__all__ = ["build_session", "settle"]
