"""Layered (RAW, PROCESSED, CURATED, ANALYTICS) datasets as Spark DataFrames."""

from strataflow.session import build_session, fresh_folder, shared_folder

__all__ = ["build_session", "fresh_folder", "shared_folder"]
