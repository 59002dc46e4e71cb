"""URL filtering by dated lists: a temporal join in DataFrame operations only.

List entries come as dated events (added, removed). They become validity
intervals [valid_from, valid_to), and every capture is judged by the entries
that were active when it was fetched.

A pattern is a domain (it covers the host itself and everything under it) or
a whole url. Captures are first reduced to distinct (host, day) and (url, day)
pairs, so a host with a third of all captures costs no more than its days; the
verdicts then go back to the captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import maybe_broadcast, written

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)"


def host_of(url: Column) -> Column:
    """Lower-case host, null without one."""
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", host)


def url_key(url: Column) -> Column:
    """The url without its fragment."""
    return F.regexp_replace(url, "#.*$", "")


def domains_of(host: Column, most: int) -> Column:
    """The host and its parent domains of at most ``most`` labels."""
    labels = F.split(host, r"\.")
    sizes = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most)))
    return F.transform(sizes, lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))


def validity_intervals(events: DataFrame) -> DataFrame:
    """(list_name, policy, kind, pattern, valid_from, valid_to) from events
    (list_name, policy, kind, pattern, action 'add' or 'remove', day).

    Repeated events change nothing; an entry both added and removed on one day
    is inactive from that day; a missing end is null. Events with a null pattern
    or day are ignored. One key's events are reduced to one row per day before
    they meet, so a key's work is bounded by the calendar."""
    key = ["list_name", "policy", "kind", "pattern"]
    daily = (events.where("pattern is not null and day is not null and action in ('add', 'remove')")
             .groupBy(*key, F.col("day").cast("date").alias("day")).agg(F.min(F.col("action") == "add").alias("on")))
    order = Window.partitionBy(*key).orderBy("day")
    changes = daily.withColumn("was", F.lag("on").over(order)).where("on <> coalesce(was, false)")
    return (changes.withColumn("valid_to", F.lead("day").over(order)).where("on")
            .select(*key, F.col("day").alias("valid_from"), "valid_to"))


def filter_captures(captures: DataFrame, events: DataFrame, url_col: str = "url", fetched_col: str = "fetched_on") -> DataFrame:
    """``captures`` with blocked, matched_list, matched_pattern, listed_from.

    Of the entries active on the day of the capture the most specific decides
    (a url before any domain, a longer domain before a shorter one; at equal
    length an 'allow' policy before 'block', then the later name and start).
    A null or malformed url and a null day match nothing and are not blocked.
    Repeated rows are judged alike; all columns pass through (old columns of
    the new names are replaced); an empty table gives an empty result, empty
    lists block nothing."""
    new = ["blocked", "matched_list", "matched_pattern", "listed_from"]
    kept = [c for c in captures.columns if c not in new]
    day = F.col(fetched_col).cast("date")
    rows = captures.select(*kept, host_of(F.col(url_col)).alias("__host"), url_key(F.col(url_col)).alias("__url"), day.alias("__day"))
    hosts = rows.where("__host is not null and __day is not null").groupBy("__host", "__day").agg(F.first(F.lit(1)).alias("one"))
    urls = rows.where("__url is not null and __day is not null").groupBy("__url", "__day").agg(F.first(F.lit(1)).alias("one"))
    # no pattern covers a domain of more labels than the longest pattern has
    most = events.where("kind = 'domain'").agg(F.max(F.size(F.split("pattern", r"\.")))).first()[0] or 1
    asked = (hosts.select(F.lit("domain").alias("kind"), F.col("__host").alias("asked"), F.explode(domains_of(F.col("__host"), max(1, most))).alias("pattern"), "__day")
             .unionByName(urls.select(F.lit("url").alias("kind"), F.col("__url").alias("asked"), F.col("__url").alias("pattern"), "__day")))
    lists = validity_intervals(events)
    active = asked.join(lists, ["kind", "pattern"]).where((F.col("valid_from") <= F.col("__day")) & (F.col("valid_to").isNull() | (F.col("__day") < F.col("valid_to"))))
    rank = F.struct((F.col("kind") == "url").alias("url"), F.length("pattern").alias("long"), (F.col("policy") == "allow").alias("allow"), "list_name", "valid_from", "pattern")
    verdicts = written(active.groupBy("kind", "asked", "__day").agg(F.max(rank).alias("m")), "url_verdicts")
    n = verdicts.count()
    host_hit = verdicts.where("kind = 'domain'").select(F.col("asked").alias("__host"), "__day", F.col("m").alias("__by_host"))
    url_hit = verdicts.where("kind = 'url'").select(F.col("asked").alias("__url"), "__day", F.col("m").alias("__by_url"))
    judged = rows.join(maybe_broadcast(host_hit, n, 512), ["__host", "__day"], "left").join(maybe_broadcast(url_hit, n, 512), ["__url", "__day"], "left")
    m = F.coalesce("__by_url", "__by_host")
    return judged.select(*kept, F.coalesce(~m["allow"], F.lit(False)).alias("blocked"), m["list_name"].alias("matched_list"),
                         m["pattern"].alias("matched_pattern"), m["valid_from"].alias("listed_from"))
