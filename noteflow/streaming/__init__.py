"""Micro-batch adapter for the batch operators (the reference has no streaming)."""

from .microbatch import stream_through  # noqa: F401
