"""Jobs put together from tables, views and inserts."""

from tidemark.plans.job import Insert, Job, View
from tidemark.plans.preview import is_cut, page, preview, preview_statement
from tidemark.plans.snapshots import Snapshot, StreamPreview

__all__ = ["Insert", "Job", "Snapshot", "StreamPreview", "View", "is_cut", "page", "preview", "preview_statement"]
