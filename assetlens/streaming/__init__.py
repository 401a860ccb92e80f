"""Incremental use of the linkage. The source behaviour is batch only; this is the hook that
lets a stream of programme rows call it."""

from .incremental import classify_batches

__all__ = ["classify_batches"]
