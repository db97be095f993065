"""Checks, routes and summarises event streams with Spark DataFrames."""

from eventguard.config import PipelineConfig, build_session, use_utc, work_dir

__all__ = ["PipelineConfig", "build_session", "use_utc", "work_dir"]
