"""May a streaming query be run on each micro-batch by itself?"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Logical operators whose rows each come from one row of the stream (fixed values, Spark's class names).
ROW_WISE = {
    "EventTimeWatermark",
    "Filter",
    "Generate",
    "Project",
    "ResolvedHint",
    "StreamingRelation",
    "StreamingRelationV2",
    "SubqueryAlias",
    "Union",
    "View",
}
# Kinds of join with a static side that treat each row of the stream by itself, by the stream's side.
JOINS = {0: {"Inner", "Cross", "LeftOuter", "LeftSemi", "LeftAnti"}, 1: {"Inner", "Cross", "RightOuter"}}


def _children(node) -> list:
    return [node.children().apply(i) for i in range(node.children().size())]


def _asks_a_stream(node) -> bool:
    """Whether an expression of the node has a subquery over a stream."""
    plans = node.subqueries()
    return any(plans.apply(i).isStreaming() for i in range(plans.size()))


def is_row_wise(df: DataFrame, lookups: bool = False) -> bool:
    """True only if every streaming operator is known to treat each row by itself.

    With ``lookups``, rows may also be joined, as the left side, to what is made of the same
    rows: an as-of join looks up the versions of its own probes.
    """
    pending = [df._jdf.queryExecution().analyzed()]
    while pending:
        node = pending.pop()
        if not node.isStreaming():
            continue
        children = _children(node)
        if _asks_a_stream(node):
            return False
        if node.nodeName() == "Join":
            streams = [i for i, child in enumerate(children) if child.isStreaming()]
            kind = node.joinType().toString()
            if len(streams) == 1 and kind in JOINS[streams[0]]:
                pending.append(children[streams[0]])
            elif lookups and len(streams) == 2 and kind in ("Inner", "LeftOuter"):
                pending.append(children[0])
            else:
                return False
        elif node.nodeName() in ROW_WISE:
            pending += children
        else:
            return False
    return True

