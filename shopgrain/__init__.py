"""Sales analytics on Spark: delimited files in, keyed tables, eight reports."""

from shopgrain.session import build_session, configure

__all__ = ["build_session", "configure"]
