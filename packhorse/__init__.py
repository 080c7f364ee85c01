"""Packhorse: extract, transform and load operators as plain PySpark DataFrame functions."""

from packhorse.session import build_session, release_scratch, scratch_path

__all__ = ["build_session", "release_scratch", "scratch_path"]
