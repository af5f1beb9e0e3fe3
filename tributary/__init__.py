"""Reporting tables from raw e-commerce, repository, catalogue and sensor data."""

from tributary.session import get_session

__all__ = ["get_session"]
