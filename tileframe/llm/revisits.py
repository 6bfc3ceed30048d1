"""Resolution of not-modified revisits in a web archive.

A revisit record says that a page had not changed; its payload lies with an earlier capture. It is joined, as of
its time, to the latest strictly earlier full response of the same canonical URL. Its validator decides
whether that is the right one: the entity tag if the revisit has one, otherwise the date of last modification. A resolved
revisit gets the response's headers, in which those that a not-modified answer may carry are replaced by its own.

The as-of join has no hot URL: rows are range-partitioned on (URL, time) into sorted runs, a window within a run finds
most answers, and a run's first URL takes over the last response of the runs before it, which is at most one line
per run. Payloads are not moved: a revisit names the record that holds its payload.

Defined results: a null URL is resolved by nothing; a null time is earlier than all others and never later than one; of
responses with the same time the larger id counts; repeated rows each stay; null headers are no headers; other columns
are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tileframe.llm.common import stored
from tileframe.operators.ordered import POS, RUN, sorted_runs

#: Headers that a not-modified answer carries for the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
_TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid|sessionid)"


def canonical_url(url: Column) -> Column:
    """One spelling per page: no scheme, user, ``www.``, default port, fragment, tracking parameters or closing slash; the host
    in lower case."""
    out = F.regexp_replace(F.btrim(url), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?", "")
    out = F.regexp_replace(out, r"#.*$", "")
    host = F.lower(F.regexp_extract(out, r"^[^/?]*", 0))
    host = F.regexp_replace(host, r":(?:80|443)$", "")
    rest = F.regexp_replace(out, r"^[^/?]*", "")
    rest = F.regexp_replace(rest, rf"([?&]){_TRACKING}=[^&]*", "$1")
    rest = F.regexp_replace(rest, r"&{2,}", "&")
    rest = F.regexp_replace(rest, r"\?&", "?")
    rest = F.regexp_replace(rest, r"[?&]+$", "")
    rest = F.regexp_replace(rest, r"/(\?|$)", "$1")
    return F.concat(host, rest)


def latest_before(rows: DataFrame, key: str, time: str, record: str, value: str) -> DataFrame:
    """``rows`` with ``_latest``: the ``value`` of the last row before it, in strictly earlier time, whose value is not
    null, within the same ``key``. ``record`` orders rows of one time."""
    has = F.col(value).isNotNull()
    ordered = rows.withColumn("_has", has)
    runs = sorted_runs(ordered, [key, time, "_has", record])
    # Rows of one time stand with those that look first, so none sees a value of its own time.
    earlier = Window.partitionBy(key, RUN).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    near = runs.withColumn("_near", F.last(value, ignorenulls=True).over(earlier))
    ends = runs.groupBy(key, RUN).agg(F.max_by(value, F.when(F.col("_has"), F.col(POS))).alias("_end"))
    across = Window.partitionBy(key).orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(across))
    # Only a key that reaches over a run's end has a line here: not more lines than runs.
    carried = carried.where("_carried IS NOT NULL").select(F.col(key).alias("_k"), F.col(RUN).alias("_r"), "_carried")
    joined = near.join(F.broadcast(carried), (F.col(key) == F.col("_k")) & (F.col(RUN) == F.col("_r")), "left")
    return joined.withColumn("_latest", F.coalesce("_near", "_carried")).drop(
        "_k", "_r", "_carried", "_near", "_has", RUN, POS
    )


def merged_headers(stored_headers: Column, own: Column) -> Column:
    """The stored headers with the permitted ones of the revisit; names in lower case."""
    allowed = F.array(*[F.lit(h) for h in PERMITTED])
    mine = F.map_filter(own, lambda k, v: F.array_contains(allowed, k))
    kept = F.map_filter(stored_headers, lambda k, v: ~F.array_contains(F.map_keys(mine), k))
    return F.map_concat(kept, mine)


def _lower_names(headers: str) -> Column:
    empty = F.expr("cast(map() as map<string, string>)")
    pairs = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    # Of names that differ in case only, the first counts.
    first = F.filter(
        pairs, lambda e, i: F.array_position(F.transform(pairs, lambda x: x["key"]), e["key"]) == i + 1
    )
    return F.coalesce(F.map_from_entries(first), empty)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records``: ``record_id, url, ts, kind`` (``response`` or ``revisit``), ``headers`` (a map of text to text),
    ``digest``. Per record: ``record_id, canonical, kind, outcome, payload_id, digest, headers``.

    ``outcome``: ``full`` for responses, and for revisits ``resolved``, ``changed`` (a validator differs), ``unchecked`` (no
    validator) or ``missing`` (no earlier response). Only resolved revisits get a payload and the merged headers."""
    rows = records.select(
        "record_id", canonical_url(F.col("url")).alias("canonical"), "ts", "kind",
        _lower_names("headers").alias("headers"), "digest",
    )
    source = F.when(
        (F.col("kind") == "response") & F.col("canonical").isNotNull(), F.struct("record_id", "digest", "headers")
    )
    found = latest_before(rows.withColumn("_source", source), "canonical", "ts", "record_id", "_source")
    old, own = F.col("_latest.headers"), F.col("headers")

    def of(headers: Column, name: str) -> Column:
        return F.get(F.map_values(F.map_filter(headers, lambda k, v: k == name)), F.lit(0))

    tag, date = of(own, "etag"), of(own, "last-modified")
    outcome = (
        F.when(F.col("kind") == "response", "full")
        .when(F.col("_latest").isNull(), "missing")
        .when(tag.isNotNull(), F.when(tag.eqNullSafe(of(old, "etag")), "resolved").otherwise("changed"))
        .when(date.isNotNull(), F.when(date.eqNullSafe(of(old, "last-modified")), "resolved").otherwise("changed"))
        .otherwise("unchecked")
    )
    found = stored(found.withColumn("outcome", outcome), "revisits")
    resolved = F.col("outcome") == "resolved"
    full = F.col("outcome") == "full"
    return found.select(
        "record_id", "canonical", "kind", "outcome",
        F.when(full, F.col("record_id")).when(resolved, F.col("_latest.record_id")).alias("payload_id"),
        F.when(full, F.col("digest")).when(resolved, F.col("_latest.digest")).alias("digest"),
        F.when(resolved, merged_headers(old, own)).otherwise(own).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Two visits of every page, in a table of archive records: the first is a full response; the second, a million
    ticks later, is a revisit, or a full response of changed content for every third page. Some revisits carry
    another page's entity tag, only a date, or no validator."""
    html = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select("page_id", "url", F.md5(html).alias("md5"), F.md5(F.concat(html, F.lit("#2"))).alias("md5_2"))
    date = F.concat(F.lit("day "), F.expr("page_id div 10").cast("string"))
    first = base.select(
        (F.col("page_id") * 2).alias("record_id"), "url", F.col("page_id").alias("ts"), F.lit("response").alias("kind"),
        F.create_map(
            F.lit("ETag"), F.col("md5"), F.lit("Last-Modified"), date, F.lit("Content-Type"), F.lit("text/html"),
            F.lit("Cache-Control"), F.lit("no-cache"),
        ).alias("headers"),
        F.col("md5").alias("digest"),
    )
    again = F.col("page_id") % 3 == 0
    tag = F.when(F.col("page_id") % 5 == 1, F.lit("other")).otherwise(F.col("md5"))
    revisit = (
        F.when(F.col("page_id") % 7 == 1, F.create_map(F.lit("Date"), F.lit("now")))
        .when(F.col("page_id") % 7 == 2, F.create_map(F.lit("Last-Modified"), date, F.lit("Date"), F.lit("now")))
        .otherwise(
            F.create_map(
                F.lit("ETag"), tag, F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Content-Type"), F.lit("text/plain")
            )
        )
    )
    second = base.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", (F.col("page_id") + 1_000_000).alias("ts"),
        F.when(again, F.lit("response")).otherwise(F.lit("revisit")).alias("kind"),
        F.when(again, F.create_map(F.lit("ETag"), F.col("md5_2"), F.lit("Content-Type"), F.lit("text/html")))
        .otherwise(revisit).alias("headers"),
        F.when(again, F.col("md5_2")).alias("digest"),
    )
    return first.union(second)
