"""Incremental jobs: Structured Streaming around the batch operators."""

from .jobs import *  # noqa: F401,F403
