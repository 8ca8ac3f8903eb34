"""Entity-level metric tables from messy public-sector files, as Spark plans."""

from wardmetrics.session import build_session, scratch_path, tune

__all__ = ["build_session", "scratch_path", "tune"]
