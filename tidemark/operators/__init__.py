"""``DataFrame -> DataFrame`` operators; each one serves batch and stream unless it says otherwise."""

from tidemark.operators.asof import as_of_join
from tidemark.operators.intervals import interval_join
from tidemark.operators.latest import latest_per_key, merge_latest
from tidemark.operators.routing import split_by, with_route, write_routed
from tidemark.operators.sketches import merge_visitors, rolling_visitors, visitor_sketches
from tidemark.operators.views import align, view
from tidemark.operators.visitors import pv_uv, pv_uv_approx, pv_uv_running, uv_running
from tidemark.operators.windows import rate_and_gap, session, slide, tumble

__all__ = [
    "align",
    "as_of_join",
    "interval_join",
    "latest_per_key",
    "merge_latest",
    "merge_visitors",
    "pv_uv",
    "pv_uv_approx",
    "pv_uv_running",
    "rate_and_gap",
    "rolling_visitors",
    "session",
    "slide",
    "split_by",
    "tumble",
    "uv_running",
    "view",
    "visitor_sketches",
    "with_route",
    "write_routed",
]
