"""Pingline: ping, sensor and event analytics on Spark DataFrames."""

from pingline.session import build_session, configure, scratch_path, stored

__all__ = ["build_session", "configure", "scratch_path", "stored"]
