"""Newsloom: prepare, classify and evaluate labelled news text on Spark."""

from newsloom.session import create_spark_session

__all__ = ["create_spark_session"]
