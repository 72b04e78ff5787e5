"""Folder-arrival trigger for the batch loop (see :mod:`.arrival`)."""

from .arrival import arrivals, watch

__all__ = ["arrivals", "watch"]
