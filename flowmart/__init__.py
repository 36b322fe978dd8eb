"""flowmart: freight-flow analytics as PySpark jobs."""

from flowmart.session import build_session, configure

__all__ = ["build_session", "configure"]
