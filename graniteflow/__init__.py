"""Spark-native operators for text, clustering, recommendation and regression tables."""

from graniteflow.session import build_session

__all__ = ["build_session"]
