"""Resolution of not-modified revisits in a web archive.

A revisit record says that a page was fetched again and had not changed; it has headers but no
body. It is resolved by the latest earlier full response of the same canonical URL, if their
validators agree, and the stored headers are brought up to date as a cache would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import handed_over, release

#: Query parameters that name the visit, not the page.
VISIT_PARAMETERS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ref",
                    "fbclid", "gclid")
#: Headers of a not-modified answer that do not replace the stored ones, since they
#: describe the body or the connection (RFC 9111, section 3.2).
NOT_UPDATED = ("connection", "content-encoding", "content-length", "content-range",
               "content-type", "keep-alive", "proxy-connection", "te", "trailer",
               "transfer-encoding", "upgrade")


def canonical(url: Column) -> Column:
    """Address of a page without scheme, ``www.``, default port, fragment, visit parameters,
    order of parameters and closing slash; host in lower case. Null stays null."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    place = F.regexp_replace(bare, r"\?.*$", "")
    host = F.lower(F.regexp_replace(place, r"/.*$", ""))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(place, r"^[^/]*", ""), r"/+$", "")
    asked = F.when(bare.contains("?"), F.regexp_replace(bare, r"^[^?]*\?", "")).otherwise("")
    visit = rf"^(|({'|'.join(VISIT_PARAMETERS)})(=.*)?)$"
    kept = F.array_sort(F.filter(F.split(asked, "&"), lambda p: ~p.rlike(visit)))
    return F.concat(
        host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    )


def _latest_full(records: DataFrame) -> DataFrame:
    """Adds ``_target``: the latest earlier full record of the same address, or null.

    Records are range-partitioned by address and time and stored, so an address with any number
    of records spreads over many slices. Inside a slice a window finds the target; what an
    earlier slice ended with is carried over, one row per slice.
    """
    order = ["_address", "_at", "_id"]
    sliced = handed_over(
        records.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "records"
    )
    full = F.when(F.col("_full"), F.struct("_id", "_headers", "_digest"))
    inside = Window.partitionBy("_slice", "_address").orderBy("_at", "_id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # first and last address of each slice, and the last full record of the last address
    by_address = sliced.groupBy("_slice", "_address").agg(
        F.max_by(full, F.when(F.col("_full"), F.struct("_at", "_id"))).alias("_tail")
    )
    ends = by_address.groupBy("_slice").agg(
        F.min("_address").alias("_first"), F.max("_address").alias("_last"),
        F.max_by("_tail", "_address").alias("_tail"),
    )
    # an address that goes on from slice to slice: before its start in a slice comes what the
    # slices before it ended with
    marks = ends.select(
        F.col("_last").alias("_address"), (F.col("_slice") * 2 + 1).alias("_mark"), "_tail"
    ).unionByName(ends.select(
        F.col("_first").alias("_address"), (F.col("_slice") * 2).alias("_mark"),
        F.lit(None).cast(ends.schema["_tail"].dataType).alias("_tail"),
    ))
    before = Window.partitionBy("_address").orderBy("_mark").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        marks.withColumn("_carried", F.last("_tail", ignorenulls=True).over(before))
        .where("_mark % 2 = 0 AND _carried IS NOT NULL")
        .select(F.expr("_mark div 2").alias("_s"), F.col("_address").alias("_a"), "_carried")
    )
    return (
        sliced.withColumn("_inside", F.last(full, ignorenulls=True).over(inside))
        .join(F.broadcast(carried),
              (F.col("_slice") == F.col("_s")) & (F.col("_address") == F.col("_a")), "left")
        .withColumn("_target", F.coalesce("_inside", "_carried"))
    )


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit: record_id, address, target_id, verdict, resolved, headers, digest.

    ``records`` has record_id, url, at (any ordered type), status, headers (map of lower-case
    names) and digest (of the body). A record with status 304 is a revisit, one with status 200 a
    full response; others are left aside. Earlier means a smaller (at, record_id).

    The validators are compared in this order, the first that the revisit has deciding: etag
    (weak comparison), last-modified, digest. ``verdict`` is ``etag``, ``last-modified`` or
    ``digest`` if they agree, ``changed`` if not, ``no validator``, or ``no response`` if there is
    no earlier full response. Unless resolved, ``headers`` are the revisit's own and ``digest`` is
    null. Null urls or times have no earlier response. Null headers count as none.
    """
    none = F.expr("CAST(map() AS map<string,string>)")
    known = records.where("status IN (200, 304)").select(
        F.col("record_id").alias("_id"), canonical(F.col("url")).alias("_address"),
        F.col("at").alias("_at"), (F.col("status") == 200).alias("_full"),
        F.coalesce("headers", none).alias("_headers"), F.col("digest").alias("_digest"),
    )
    placed = "_address IS NOT NULL AND _at IS NOT NULL"
    found = _latest_full(known.where(placed)).where("NOT _full").select(
        "_id", "_address", "_headers", "_digest", "_target"
    )
    lost = known.where(f"NOT _full AND NOT ({placed})").select("_id", "_address", "_headers", "_digest")
    found = found.unionByName(lost, allowMissingColumns=True)
    own, stored = F.col("_headers"), F.col("_target")["_headers"]
    strong = lambda tag: F.regexp_replace(tag, "^W/", "")
    agree = lambda same, name: F.when(F.coalesce(same, F.lit(False)), name).otherwise("changed")
    verdict = (
        F.when(F.col("_target").isNull(), "no response")
        .when(own["etag"].isNotNull(), agree(strong(own["etag"]) == strong(stored["etag"]), "etag"))
        .when(own["last-modified"].isNotNull(),
              agree(own["last-modified"] == stored["last-modified"], "last-modified"))
        .when(F.col("_digest").isNotNull(),
              agree(F.col("_digest") == F.col("_target")["_digest"], "digest"))
        .otherwise("no validator")
    )
    fresh = F.map_filter(own, lambda k, v: ~k.isin(*NOT_UPDATED))
    merged = F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(fresh, k)), fresh)
    resolved = F.col("verdict").isin("etag", "last-modified", "digest")
    return found.withColumn("verdict", verdict).select(
        F.col("_id").alias("record_id"), F.col("_address").alias("address"),
        F.col("_target")["_id"].alias("target_id"), "verdict", resolved.alias("resolved"),
        F.when(resolved, merged).otherwise(own).alias("headers"),
        F.when(resolved, F.col("_target")["_digest"]).alias("digest"),
    )
