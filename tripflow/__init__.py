"""tripflow: bike-share trip analytics as Spark DataFrame jobs."""

from tripflow.session import build_session

__all__ = ["build_session"]
