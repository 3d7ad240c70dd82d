"""Spark-native engine for entity catalogues: scans, merging, statistics, ranking and change tracking."""

from ferrule.session import get_session

__all__ = ["get_session"]
