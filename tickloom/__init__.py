"""Ticket and event-history analytics as Spark DataFrame jobs."""

from tickloom.session import build_session

__all__ = ["build_session"]
