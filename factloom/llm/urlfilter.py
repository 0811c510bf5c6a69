"""Operator 10: URL filters by a temporal list join, in DataFrame functions only.

Dated list entries (an entry is added to or removed from a list on a day) become validity intervals.
An as-of join then evaluates every capture against the entries active on its own fetch day: captures
offer the keys they can match (their host, each parent domain, each path prefix) and meet the list by
equal keys, so no capture is compared with entries that cannot match. The most specific active entry
decides: a path prefix before a host before a domain, a longer one before a shorter one.

Entries: kind ('domain', 'host', 'prefix'), value, action ('block', 'allow'), day, change ('add',
'remove'), seq. For one key each entry ends the one before it; on one day the highest seq counts.

Skew: equal captures are one row until the end (a count brings them back), a hot host's rows meet at
most one active entry for each key, and a list of up to SENT rows is broadcast, a larger one joined
by shuffle, where adaptive execution splits hot keys.

Defined cases: a null url, or one without a host, has no keys, a null host and verdict 'none'; a null
fetch day matches no entry; null values, kinds or days in entries are no entries; empty tables work;
other columns of captures are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most list rows that are broadcast (about 100 bytes each).
SENT = 100_000


def intervals(entries: DataFrame) -> DataFrame:
    """kind, value, action, since, until: validity from `since` up to, not including, `until`."""
    dated = entries.where("kind is not null and value is not null and day is not null").select(
        "kind", F.lower(F.trim("value")).alias("value"), "action", F.col("day").cast("date").alias("since"), "change", "seq"
    )
    last = dated.groupBy("kind", "value", "since").agg(F.max_by(F.struct("action", "change"), F.struct("seq", "action", "change")).alias("e"))
    key = Window.partitionBy("kind", "value").orderBy("since")
    return (
        last.withColumn("until", F.lead("since").over(key))
        .where("e.change = 'add'")
        .select("kind", "value", "e.action", "since", "until")
    )


def host(url: Column) -> Column:
    """The host in lower case, without user and port; null where there is none."""
    found = F.lower(F.regexp_extract(url, r"(?i)^\s*[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"(?i)^\s*[a-z][a-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def keys(url: Column) -> Column:
    """Every (kind, value) that the url matches."""
    name = host(url)
    labels = F.split(name, r"\.")
    steps = F.filter(F.split(F.lower(path(url)), "/"), lambda s: s != "")
    n = F.size(labels)
    kind = lambda k, v: F.struct(F.lit(k).alias("kind"), v.alias("value"))
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: kind("domain", F.array_join(F.slice(labels, i, n), ".")))
    prefixes = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(steps)), lambda i: i > 0),
        lambda i: kind("prefix", F.concat(name, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/"))),
    )
    return F.when(name.isNotNull(), F.concat(F.array(kind("host", name)), domains, prefixes))


def evaluate(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", day: str = "fetched") -> DataFrame:
    """For every capture: its key, host, fetched, active (entries that match), the deciding entry, verdict, kept."""
    valid = intervals(entries)
    small = valid.limit(SENT + 1).count() <= SENT
    once = captures.groupBy(F.col(key).alias("id"), F.col(url).alias("url"), F.col(day).cast("date").alias("fetched")).agg(
        F.count("*").cast("int").alias("copies")
    )
    offered = once.select("*", F.explode_outer(keys(F.col("url"))).alias("k")).select(
        "id", "url", "fetched", "copies", "k.kind", "k.value"
    )
    active = (F.col("fetched") >= F.col("since")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until")))
    side = F.broadcast(valid) if small else valid
    met = offered.join(side, (offered.kind == side.kind) & (offered.value == side.value) & active, "left").drop(
        offered.kind, offered.value
    )
    rank = F.when(F.col("kind") == "prefix", 3).when(F.col("kind") == "host", 2).otherwise(1)
    entry = F.struct(rank.alias("rank"), F.length("value").alias("n"), "value", "kind", "action", "since")
    best = met.groupBy("id", "url", "fetched", "copies").agg(
        F.count("value").alias("active"), F.max(F.when(F.col("value").isNotNull(), entry)).alias("e")
    )
    return best.select("*", F.explode(F.sequence(F.lit(1), "copies"))).select(
        F.col("id").alias(key),
        host(F.col("url")).alias("host"),
        "fetched",
        "active",
        F.col("e.kind").alias("entry_kind"),
        F.col("e.value").alias("entry_value"),
        F.col("e.since").alias("entry_since"),
        F.coalesce("e.action", F.lit("none")).alias("verdict"),
        F.coalesce(F.col("e.action") != "block", F.lit(True)).alias("kept"),
    )
