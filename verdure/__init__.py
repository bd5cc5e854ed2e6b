"""Retail and inventory analytics for PySpark."""

from verdure.session import build_session

__all__ = ["build_session"]
