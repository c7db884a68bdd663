"""User functions."""

from tidemark.functions.registry import UserAggregate, aggregate_by_key, register

__all__ = ["UserAggregate", "aggregate_by_key", "register"]
