"""Data-pipeline operators for Spark: plain functions from DataFrame to DataFrame."""

from ledgerflow.session import build_session, release_staged, scratch_path, stage, staging

__all__ = ["build_session", "release_staged", "scratch_path", "stage", "staging"]
