"""Structured Streaming forms of the batch jobs (file-drop folders)."""

from .incremental import start_class_counts, start_dq_monitor, start_tax_streams
from .uniqueness import compact_counts, start_uniqueness_monitor, uniqueness_results

__all__ = ["compact_counts", "start_class_counts", "start_dq_monitor", "start_tax_streams", "start_uniqueness_monitor", "uniqueness_results"]
