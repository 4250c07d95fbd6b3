"""Structured Streaming runners for continuous incremental loads."""

from .incremental import run_available_now

__all__ = ["run_available_now"]
