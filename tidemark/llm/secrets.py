"""Secret scan with linking of credentials that come in several parts. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BODY, KEY, TWIN, keyed

ASSIGN = (
    r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))"
)
#: kind, regex (group 1: the span), group that must be long enough, its least length, a cheap test that a text may have one
STRONG = (
    ("assign", ASSIGN, 2, 12, r"[Ww][Oo][Rr][Dd]|[Ss][Ww][Dd]|[Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Kk][Ee][Yy]"),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 18, "AKIA"),
    ("hex", r"([0-9a-f]{16,})", 1, 16, r"[0-9a-f]{16}"),
)
WEAK = (
    ("weak_id", r"((?i:user(?:name|_?id)?|login|account|client_?id)[\"']?\x20?[:=]\x20?[\"']?[A-Za-z0-9._@-]+)", 1, 6, "[:=]"),
    (
        "weak_secret",
        r"((?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[a-z])(?=[A-Za-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{20,}={0,2})",
        1,
        20,
        r"[A-Za-z0-9+/_-]{20}",
    ),
    ("endpoint", r"((?:[a-z][a-z0-9+]{1,9}://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+)|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]+)?(?![0-9.]))", 1, 7, r"://|[0-9]\.[0-9]"),
)
#: What a kind of span is a part of, and the parts that complete each of them.
ROLE = {"assign": "secret", "access": "id", "hex": "secret", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint"}
COMPLETES = {"id": ("secret",), "secret": ("id", "endpoint"), "endpoint": ("secret",)}
ORDER = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")


def _matches(rows: DataFrame, kind: str, regex: str, group: int, least: int, test: str) -> DataFrame:
    """Starts and ends, in code points, of leftmost non-overlapping matches that are long enough.

    Between matches lie the pieces of a split by the same regex; running sums of lengths
    give positions. Every match counts for those, short ones are dropped afterwards.
    """
    body = F.col(BODY)
    found = F.regexp_extract_all(body, F.lit(regex), F.lit(1))
    held = found if group == 1 else F.regexp_extract_all(body, F.lit(regex), F.lit(group))
    gaps = F.split(body, regex, -1)
    lengths = F.zip_with(
        F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len"))),
        held,
        lambda x, h: F.struct(x["gap"].alias("gap"), x["len"].alias("len"), F.length(h).alias("held")),
    )
    each = rows.where(body.rlike(test)).select(KEY, TWIN, F.posexplode(lengths).alias("no", "m")).select(KEY, TWIN, "no", "m.*")
    upto = Window.partitionBy(KEY, TWIN).orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.dropDuplicates([KEY, TWIN, "no"]).withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto))
    spans = each.where(F.col("held") >= least)
    return spans.select(KEY, TWIN, F.lit(kind).alias("kind"), (F.col("end") - F.col("len")).alias("start"), "end")


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def _rank() -> Column:
    return F.create_map(*[x for i, kind in enumerate(ORDER) for x in (F.lit(kind), F.lit(i))])[F.col("kind")]


def _linked(every: DataFrame, scope: int) -> DataFrame:
    """Spans with the nearest part of each role that completes them, if it starts at most ``scope`` code points away.

    An interval join: each span looks up its own stretch of ``scope`` code points and the two
    beside it. Parts of a role in a stretch come as one row, and no more of them than a stretch
    has places to start, so the join meets three rows for each span and role.
    """
    role = F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])
    every = every.withColumn("role", role[F.col("kind")]).withColumn("rank", _rank())
    at = F.floor(F.col("start") / scope)
    parts = every.groupBy(KEY, TWIN, "role", at.alias("stretch")).agg(F.collect_list(F.struct("start", "rank", "kind", "end")).alias("parts"))
    needs = F.create_map(*[x for own, roles in COMPLETES.items() for x in (F.lit(own), F.array(*[F.lit(r) for r in roles]))])
    asks = every.withColumn("wanted", F.explode(needs[F.col("role")])).withColumn("look", F.explode(F.array(at - 1, at, at + 1)))
    same = f"a.{KEY} <=> p.{KEY} AND a.{TWIN} = p.{TWIN} AND a.wanted = p.role AND a.look = p.stretch"
    distances = "transform(p.parts, x -> struct(abs(x.start - a.start) AS far, x.start AS start, x.rank AS rank, x.kind AS kind, x.end AS end))"
    met = asks.alias("a").join(parts.alias("p"), F.expr(same)).withColumn("near", F.expr(f"array_min({distances})")).where(F.col("near.far") <= scope)
    return met.groupBy(F.col(f"a.{KEY}").alias(KEY), F.col(f"a.{TWIN}").alias(TWIN), "kind", "start", "end", "wanted").agg(F.min("near").alias("near")).drop("wanted")


def _outside(base: DataFrame, weak: DataFrame) -> DataFrame:
    """Weak spans that do not begin within a strong one."""
    both = base.withColumn("strong", F.lit(True)).unionByName(weak.withColumn("strong", F.lit(False)))
    upto = Window.partitionBy(KEY, TWIN).orderBy("start", F.desc("strong")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.coalesce(F.max(F.when(F.col("strong"), F.col("end"))).over(upto), F.lit(0))
    return both.withColumn("reach", reach).where(~F.col("strong") & (F.col("start") >= F.col("reach"))).drop("strong", "reach")


def scan_secrets(docs: DataFrame, scope: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, linked, links) for every row: arrays of (start, rank, kind, end), in that order.

    ``base`` has the strong spans: assignments to names of secrets, access ids and long hex
    runs. Weak candidates (account names, mixed tokens, endpoints) are in ``linked`` only
    where a complementary part lies within ``scope`` code points: an id or an endpoint for
    a token, a secret for an account name or an endpoint. One that begins in a strong span
    is no candidate. ``links`` tell what goes with what: each span of either kind, and as
    ``part`` the nearest one of each role that completes it within ``scope``; of two at one
    distance the one that starts first, then the one whose kind comes first.

    A null or empty text has no spans. Rows with equal id and text have equal results; rows
    of one id with different texts are kept apart. A null id is carried through. Only the two
    named columns are read. An empty table gives an empty table.
    """
    rows = keyed(docs, id_col, text_col)
    base = _union([_matches(rows, *rule) for rule in STRONG])
    weak = _outside(base, _union([_matches(rows, *rule) for rule in WEAK]))
    found = _linked(base.unionByName(weak), scope)
    span, strong = F.struct("start", _rank().alias("rank"), "kind", "end"), F.col("kind").isin(*[rule[0] for rule in STRONG])
    link = F.struct(*[span[c].alias(c) for c in ("start", "rank", "kind", "end")], F.struct(*[F.col(f"near.{c}").alias(c) for c in ("start", "rank", "kind", "end")]).alias("part"))
    has_part = F.col("near").isNotNull()
    gathered = base.unionByName(found, allowMissingColumns=True).groupBy(KEY, TWIN)
    spans = gathered.agg(
        F.sort_array(F.collect_list(F.when(~has_part, span))).alias("base"),
        F.sort_array(F.collect_set(F.when(has_part & ~strong, span))).alias("linked"),
        F.sort_array(F.collect_list(F.when(has_part, link))).alias("links"),
    )
    rows, spans = rows.select(KEY, TWIN).alias("r"), spans.alias("s")
    joined = rows.join(spans, F.expr(f"r.{KEY} <=> s.{KEY} AND r.{TWIN} = s.{TWIN}"), "left")
    fields = "start:bigint,rank:int,kind:string,end:bigint"
    some = lambda name, kind: F.coalesce(name, F.array().cast(f"array<{kind}>")).alias(name)
    return joined.select(
        F.col(f"r.{KEY}").alias("doc_id"),
        some("base", f"struct<{fields}>"),
        some("linked", f"struct<{fields}>"),
        some("links", f"struct<{fields},part:struct<{fields}>>"),
    )


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def links_listed(links: Column) -> Column:
    """kind:start:end>kind:start:end for each link, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    return F.array_join(F.transform(links, lambda x: F.concat_ws(">", one(x), one(x["part"]))), ",")
