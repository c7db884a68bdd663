"""The registered queries, each with the SQL that gives the same rows."""

from tidemark.queries import feeds, relational, stateful, streams, timeline, visits

CATALOG = {**feeds.CATALOG, **visits.CATALOG, **timeline.CATALOG, **relational.CATALOG, **streams.CATALOG, **stateful.CATALOG}
