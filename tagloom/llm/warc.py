"""Not-modified revisits of a web archive: as-of join by canonical URL, validators, header merge. Built-in functions only.

A revisit record says that a page had not changed. It is resolved by the latest earlier full response of the same
canonical URL, if the revisit's validator fits that response; the result has the response's headers, updated by those that a
not-modified answer may carry.

A URL with very many captures is cut into time cells: each cell finds its own latest response, and a running
maximum over the cells' last responses, one row per cell, fills in what lies before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import stored

ROWS_PER_CELL = 50_000
# Fields that a 304 answer may update (RFC 9110, 15.4.5), and query parameters that only track.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
TRACKING = r"(utm_[a-z]+|fbclid|gclid)"
KINDS = ["response", "revisit"]


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, default port, fragment, tracking parameters and a final slash removed, host in lower case.

    Null gives an empty URL.
    """
    u = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), r"#.*$", "")
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    u = F.regexp_replace(u, rf"([?&]){TRACKING}=[^&]*", "$1")
    u = F.regexp_replace(F.regexp_replace(F.regexp_replace(u, r"&&+", "&"), r"\?&+", "?"), r"[?&]+$", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(u, r"^([^/?]*)", 1)), r"^www\.", ""), r":(80|443)$", "")
    rest = F.regexp_replace(F.regexp_replace(u, r"^[^/?]*", ""), r"/+(\?|$)", "$1")
    return F.concat(host, rest)


def latest_before(rows: DataFrame, by: str, at: str, value: Column, cells: int) -> DataFrame:
    """``rows`` with ``_found``: the largest ``value`` (a struct that begins with ``at``; null for rows that are not looked up)
    of the rows with the same ``by`` and a smaller ``at``."""
    span = rows.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
    low, high = (span.low, span.high) if span.low is not None else (0, 0)
    width = max(1, -(-(high - low + 1) // max(cells, 1)))
    cut = rows.withColumn("_cell", F.floor((F.col(at) - low) / width)).withColumn("_value", value)
    last = cut.groupBy(by, "_cell").agg(F.max("_value").alias("_last"))
    before = Window.partitionBy(by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(F.col(by).alias("_by"), F.col("_cell").alias("_of"), F.max("_last").over(before).alias("_carried"))
    earlier = Window.partitionBy(by, "_cell").orderBy(at).rangeBetween(Window.unboundedPreceding, -1)
    inside = cut.withColumn("_inside", F.max("_value").over(earlier))
    joined = inside.join(carried, (inside[by] == carried["_by"]) & (inside["_cell"] == carried["_of"]))
    return joined.select(*rows.columns, F.coalesce("_inside", "_carried").alias("_found"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit record: ``record_id, canonical, ref_id, state, headers``.

    ``records`` has ``record_id, url, kind, at`` (whole number), ``digest`` and ``headers`` (map with lower-case names). The latest
    earlier response is the one with the largest ``at`` below the revisit's, among equal times the one with the largest id.
    ``state`` is ``unresolved`` (no earlier response, ``ref_id`` null), ``mismatch`` (an entity tag, else a date, else a
    digest differs, or the revisit has no validator) or ``resolved``; only then ``headers`` are the merged ones, else the
    revisit's own. Entity tags compare weakly. Null headers are empty. A revisit without a time is ``unresolved``, since nothing
    is known to be earlier; a response without a time answers nothing, and records of another or a null kind are left out.
    """
    none = F.create_map().cast("map<string,string>")
    known = records.where((F.col("kind") == "revisit") | (F.col("at").isNotNull() & F.col("kind").isin(KINDS))).select(
        "record_id", canonical_url(F.col("url")).alias("canonical"), "kind", F.col("at").cast("long").alias("at"), "digest",
        F.coalesce("headers", none).alias("headers"),
    )
    known = stored(known, "records")
    answer = F.when(F.col("kind") == "response", F.struct(
        "at", "record_id", "digest",
        F.regexp_replace(F.col("headers")["etag"], "^W/", "").alias("etag"), F.col("headers")["last-modified"].alias("modified"),
    ))
    narrow = known.select("record_id", "canonical", "kind", "at", "digest", "headers", answer.alias("_answer"))
    timed = latest_before(narrow.where("at is not null"), "canonical", "at", F.col("_answer"), -(-known.count() // ROWS_PER_CELL))
    timeless = narrow.where("at is null").withColumn("_found", F.col("_answer"))  # a revisit's is null
    found = timed.unionByName(timeless)
    etag = F.regexp_replace(F.col("headers")["etag"], "^W/", "")
    modified = F.col("headers")["last-modified"]
    fits = F.when(etag.isNotNull(), etag.eqNullSafe(F.col("_found.etag"))).when(
        modified.isNotNull(), modified.eqNullSafe(F.col("_found.modified"))
    ).otherwise(F.col("digest").isNotNull() & F.col("digest").eqNullSafe(F.col("_found.digest")))
    state = F.when(F.col("_found").isNull(), "unresolved").when(fits, "resolved").otherwise("mismatch")
    visits = found.where(F.col("kind") == "revisit").select(
        "record_id", "canonical", F.col("_found.record_id").alias("ref_id"), state.alias("state"), "headers"
    )
    # The answers' headers move only to the revisits that they resolve, spread by the revisit's id.
    full = known.where(F.col("kind") == "response").select(
        F.col("record_id").alias("_id"), F.col("headers").alias("_old")
    ).dropDuplicates(["_id"])
    joined = visits.join(full, (visits["ref_id"] == full["_id"]) & (F.col("state") == "resolved"), "left")
    new = F.map_filter("headers", lambda k, v: k.isin(PERMITTED))
    old = F.map_filter("_old", lambda k, v: ~F.array_contains(F.map_keys(new), k))
    return joined.select(
        "record_id", "canonical", "ref_id", "state",
        F.when(F.col("state") == "resolved", F.map_concat(old, new)).otherwise(F.col("headers")).alias("headers"),
    )


def archive_of(pages: DataFrame) -> DataFrame:
    """Archive records that follow from ``pages``: each page is a response, and a later revisit asks for it again.

    Times come from the page id. One revisit in five carries an outdated entity tag, one in seven only a date.
    """
    length = F.length(F.coalesce("html", F.lit(""))).cast("string")
    tag, day = F.md5(F.coalesce("html", F.lit(""))), F.concat(F.lit("day "), (F.col("page_id") % 28).cast("string"))
    first = pages.select(
        (F.col("page_id") * 2).alias("record_id"), "url", F.lit("response").alias("kind"), (F.col("page_id") * 10).alias("at"),
        F.sha1(F.coalesce("html", F.lit(""))).alias("digest"),
        F.create_map(
            F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), length, F.lit("etag"), tag,
            F.lit("last-modified"), day, F.lit("cache-control"), F.lit("max-age=60"),
        ).alias("headers"),
    )
    sent = F.when(F.col("page_id") % 5 == 0, F.lit("outdated")).otherwise(F.concat(F.lit("W/"), tag))
    dated = F.create_map(F.lit("last-modified"), day, F.lit("date"), day, F.lit("content-length"), F.lit("0"))
    tagged = F.create_map(F.lit("etag"), sent, F.lit("cache-control"), F.lit("max-age=5"), F.lit("content-length"), F.lit("0"))
    later = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.concat(F.col("url"), F.lit("#again")).alias("url"),
        F.lit("revisit").alias("kind"), (F.col("page_id") * 10 + 10 * (F.col("page_id") % 97) - 20).alias("at"),
        F.lit(None).cast("string").alias("digest"),
        F.when(F.col("page_id") % 7 == 0, dated).otherwise(tagged).alias("headers"),
    )
    return first.union(later)


def revisit_digest(pages: DataFrame) -> DataFrame:
    """``record_id, canonical, ref_id, state, headers`` with the headers as one ordered string."""
    pairs = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return resolve_revisits(archive_of(pages)).withColumn("headers", F.array_join(pairs, ";"))


_HOST = "regexp_replace(regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)), '^www\\.', ''), ':(80|443)$', '')"
ORACLE = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h, 'day ' || CAST(page_id % 28 AS VARCHAR) AS day FROM pages),
raw AS (
  SELECT page_id * 2 AS record_id, url, TRUE AS answer, page_id * 10 AS at, md5(h) AS etag, day AS modified,
    NULL AS date, 'max-age=60' AS cache, CAST(length(h) AS VARCHAR) AS size FROM p
  UNION ALL
  SELECT page_id * 2 + 1, url || '#again', FALSE, page_id * 10 + 10 * (page_id % 97) - 20,
    CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 5 = 0 THEN 'outdated' ELSE md5(h) END,
    CASE WHEN page_id % 7 = 0 THEN day END, CASE WHEN page_id % 7 = 0 THEN day END,
    CASE WHEN page_id % 7 <> 0 THEN 'max-age=5' END, '0' FROM p),
cut AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    trim(coalesce(url, '')), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '([?&]){TRACKING}=[^&]*', '\\1', 'g'),
    '&&+', '&', 'g'), '\\?&+', '?', 'g'), '[?&]+$', '') AS u FROM raw),
rec AS (SELECT *, {_HOST} || regexp_replace(regexp_replace(u, '^[^/?]*', ''), '/+(\\?|$)', '\\1') AS canonical FROM cut),
found AS (SELECT v.record_id, max(struct_pack(at := r.at, id := r.record_id)) AS best
  FROM rec v JOIN rec r ON r.answer AND NOT v.answer AND r.canonical = v.canonical AND r.at < v.at GROUP BY v.record_id),
joined AS (SELECT v.record_id, v.canonical, r.record_id AS ref_id,
  CASE WHEN r.record_id IS NULL THEN 'unresolved'
       WHEN v.etag IS NOT NULL THEN CASE WHEN v.etag = r.etag THEN 'resolved' ELSE 'mismatch' END
       WHEN v.modified = r.modified THEN 'resolved' ELSE 'mismatch' END AS state,
  v.etag AS ve, v.modified AS vm, v.date AS vd, v.cache AS vc, v.size AS vs, r.etag AS re, r.modified AS rm, r.cache AS rc, r.size AS rs
  FROM rec v LEFT JOIN found USING (record_id) LEFT JOIN rec r ON r.record_id = found.best.id WHERE NOT v.answer)
SELECT record_id, canonical, ref_id, state,
  CASE WHEN state = 'resolved' THEN concat_ws(';', 'cache-control=' || coalesce(vc, rc), 'content-length=' || rs,
    'content-type=text/html', 'date=' || vd,
    'etag=' || coalesce(CASE WHEN ve IS NOT NULL AND ve <> 'outdated' THEN 'W/' || ve ELSE ve END, re),
    'last-modified=' || coalesce(vm, rm))
  ELSE concat_ws(';', 'cache-control=' || vc, 'content-length=' || vs, 'date=' || vd,
    'etag=' || CASE WHEN ve <> 'outdated' THEN 'W/' || ve ELSE ve END, 'last-modified=' || vm) END AS headers
FROM joined
"""
