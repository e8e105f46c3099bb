"""WARC: resolution of not-modified revisit records.

A revisit record (HTTP 304) has no body.  It is resolved by an as-of join on the canonical URL: the
latest full response (a status of ``complete``, 200 unless given) that is strictly earlier; errors,
redirects and partial responses between them do not count.  Its validators must agree: entity tags are
compared when both records have one (weakly), else last-modified dates when both have one; without a
common validator the revisit is not resolved.  Permitted header fields of the 304 (``PERMITTED``) replace
those of the stored response; every other field is the stored response's.

The as-of join sorts narrow rows only (URL, time, record): they are range-partitioned by (URL, time,
id), so one URL with a third of the rows spreads over many tasks; inside a task a window carries the
last response forward, and what a URL carries into a later task comes from a table with one row for
each URL that crosses a partition border (at most two for a partition), which is broadcast.

Records: record_id long, url, captured_at (long or timestamp), status int, headers map<string,string>.

Defined results
    null url               a URL of its own: nothing is resolved against it
    null time              such a response is earlier than nothing, such a revisit has nothing earlier
    ties in time           a response of the same instant is not earlier; of several responses of
                           one instant the one with the largest record_id counts
    null status            such a record is neither a response nor a revisit: it has no row
    repeated rows          a record that is repeated is resolved each time; responses of one URL, time and id are one,
                           with the largest of their header lists
    one id on two URLs     records are told by URL, time and id, so ids that meet on several URLs do not mix
    null or empty headers  no validators, nothing to merge; names are compared in lower case
    empty table            empty result
    extra columns          ignored
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, partitions

#: Fields of a 304 that replace the stored ones.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Statuses of a full response.
COMPLETE = (200,)
#: Query parameters that do not name another resource.
TRACKING = r"(utm_[a-z]+|ref|fbclid|gclid)"


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, default port, fragment, tracking parameters and a last slash do not count."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host, rest = F.lower(F.regexp_extract(u, r"^([^/?]*)", 1)), F.regexp_extract(u, r"^[^/?]*(.*)$", 1)
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    rest = F.regexp_replace(rest, rf"([?&]){TRACKING}=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, r"&+", "&"), r"\?&", "?")
    return F.concat(host, F.regexp_replace(F.regexp_replace(rest, r"[?&]+$", ""), r"/+$", ""))


def lower_names(headers: Column) -> Column:
    """Header names in lower case; of names that then meet, the first in order."""
    entries = F.transform(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.filter(entries, lambda e: e["key"] == n)[0]["value"]))


def merged_headers(stored: Column, fresh: Column, names: Sequence[str] = PERMITTED) -> Column:
    """The stored fields, replaced by the permitted fields of the 304."""
    permitted = F.map_filter(fresh, lambda k, _: k.isin(*names))
    kept = F.map_filter(stored, lambda k, _: ~F.map_contains_key(permitted, k))
    return F.map_concat(kept, permitted)


def as_of(records: DataFrame) -> DataFrame:
    """(canon, at, record_id) of every revisit, with response_id and response_at of the latest strictly
    earlier response of its URL.

    ``records`` has canon, at, record_id and full (whether it is a response).  No row for revisits
    that have no earlier response.
    """
    spark = records.sparkSession
    rows = records.filter("canon is not null and at is not null").select("canon", "at", "full", "record_id").distinct()
    # revisits first at one instant, so that a response of the same instant stands after them
    rank = ("canon", "at", F.col("full").cast("int"), "record_id")
    dealt = materialize(rows.repartitionByRange(partitions(spark), *rank).withColumn("part", F.spark_partition_id()), "captures")
    before = W.partitionBy("part", "canon").orderBy(*rank[1:]).rowsBetween(W.unboundedPreceding, -1)
    here = dealt.withColumn("found", F.last(F.when(F.col("full"), F.struct("at", "record_id")), ignorenulls=True).over(before))
    # URLs that lie in several partitions: at most one for every border between two partitions
    ends = dealt.groupBy("canon", "part").agg(F.max(F.when(F.col("full"), F.struct("at", "record_id"))).alias("tail"))
    crossing = ends.groupBy("canon").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("canon")
    earlier = W.partitionBy("canon").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.join(crossing, "canon", "left_semi").select("canon", "part", F.last("tail", ignorenulls=True).over(earlier).alias("carry"))
    met = here.filter(~F.col("full")).join(F.broadcast(carried.filter("carry is not null")), ["canon", "part"], "left")
    found = F.coalesce("found", "carry")
    return met.select("canon", "at", "record_id", found.isNotNull().alias("answered"), found["record_id"].alias("response_id"), found["at"].alias("response_at")).filter("answered")


def resolve(records: DataFrame, complete: Sequence[int] = COMPLETE, permitted: Sequence[str] = PERMITTED) -> DataFrame:
    """One row per revisit: record_id, canonical_url, response_id, outcome and merged headers.

    ``outcome``: ``resolved``, ``changed`` (validators differ), ``unvalidated`` (no common validator) or
    ``missing`` (no earlier response); response_id and headers are null unless resolved.
    """
    status = F.col("status")
    full = F.when(status == 304, False).when(status.isin(*complete), True)
    all_ = records.select("record_id", canonical_url(F.col("url")).alias("canon"), F.col("captured_at").alias("at"), full.alias("full"), lower_names(F.col("headers")).alias("headers")).filter("full is not null")
    found = as_of(all_)
    revisits = all_.filter(~F.col("full")).select("record_id", "canon", "at", F.col("headers").alias("mine"))
    stored = (all_.filter("full and canon is not null and at is not null")
              .groupBy("canon", F.col("at").alias("response_at"), F.col("record_id").alias("response_id"))
              .agg(F.map_from_entries(F.max(F.array_sort(F.map_entries("headers")))).alias("theirs")))
    # ids may be null on either side: they meet as nulls
    same_record = [revisits["canon"] == found["canon"], revisits["at"] == found["at"], revisits["record_id"].eqNullSafe(found["record_id"])]
    met = revisits.join(found, same_record, "left").select(revisits["record_id"], revisits["canon"], revisits["at"], "mine", "answered", "response_id", "response_at")
    same_response = [met["canon"] == stored["canon"], met["response_at"] == stored["response_at"], met["response_id"].eqNullSafe(stored["response_id"])]
    met = met.join(stored, same_response, "left").select(met["record_id"], met["canon"], "mine", "answered", met["response_id"], "theirs")
    tag = lambda c: F.regexp_replace(F.col(c)["etag"], r"^W/", "")
    date = lambda c: F.col(c)["last-modified"]
    same = F.coalesce(tag("mine") == tag("theirs"), date("mine") == date("theirs"))
    outcome = (F.when(F.col("answered").isNull(), "missing").when(same, "resolved").when(~same, "changed").otherwise("unvalidated"))
    ok = outcome == "resolved"
    return met.select("record_id", F.col("canon").alias("canonical_url"), F.when(ok, F.col("response_id")).alias("response_id"), outcome.alias("outcome"),
                      F.when(ok, merged_headers(F.col("theirs"), F.col("mine"), permitted)).alias("headers"))
