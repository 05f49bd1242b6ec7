"""Incremental loading of newly arrived monthly files with Structured Streaming."""

from ledgerline.streaming.incremental import load_new_files

__all__ = ["load_new_files"]
