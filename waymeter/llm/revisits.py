"""Not-modified revisits of a web archive: each takes the latest earlier full response of its URL.

An as-of join by canonical URL. Times are cut into slices; within a slice a window looks back, and the last
response of each slice is carried to the later ones, so a URL with a large share of all records is spread over
as many tasks as there are slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymeter.session import materialize

SLICES = 64
#: Header fields that a 304 answer may renew in the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that name a visit and not a page.
VISIT_PARAMETER = "^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=.*)?$"
_URL = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?([^?#]*)(\?[^#]*)?"

RESOLVED, CHANGED, UNCHECKED, MISSING = "resolved", "changed", "unchecked", "no_original"


def canonical_url(url: Column) -> Column:
    """host, port unless 80 or 443, path and sorted query without visit parameters; null for null or no host.

    Scheme, user, `www.`, case of the host, fragment and a final slash are left out.
    """
    part = lambda k: F.regexp_extract(url, _URL, k)
    host = F.regexp_replace(F.lower(part(1)), r"^www\.", "")
    port = F.when(part(2).isin(":", ":80", ":443"), "").otherwise(part(2))
    path = F.regexp_replace(part(3), "/+$", "")
    fields = F.filter(F.split(F.substr(part(4), F.lit(2)), "&"), lambda q: (q != "") & ~F.rlike(F.lower(q), F.lit(VISIT_PARAMETER)))
    query = F.array_join(F.array_sort(fields), "&")
    return F.when(host != "", F.concat(host, port, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def _fields(headers: Column) -> Column:
    """(name in lower case, value) sorted by name, null values left out; of a repeated name the first by value."""
    pairs = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("name"), e["value"].alias("value")))
    pairs = F.coalesce(pairs, F.array().cast("array<struct<name:string,value:string>>"))
    pairs = F.array_sort(F.filter(pairs, lambda p: p["value"].isNotNull()))
    return F.filter(pairs, lambda p, k: (k == 0) | (p["name"] != F.get(pairs, k - 1)["name"]))


def _value(fields: Column, name: str) -> Column:
    return F.get(F.filter(fields, lambda p: p["name"] == name), F.lit(0))["value"]


def _tag(fields: Column) -> Column:
    """Entity tag for a weak comparison."""
    return F.regexp_replace(F.trim(_value(fields, "etag")), "^W/", "")


def outcome(ours: Column, theirs: Column) -> Column:
    """How a revisit's validators compare with the response's: the tag decides, else the time of the last change."""
    tag, other = _tag(ours), _tag(theirs)
    time, other_time = _value(ours, "last-modified"), _value(theirs, "last-modified")
    return (
        F.when(tag.isNotNull() & other.isNotNull(), F.when(tag == other, RESOLVED).otherwise(CHANGED))
        .when(time.isNotNull() & other_time.isNotNull(), F.when(time == other_time, RESOLVED).otherwise(CHANGED))
        .otherwise(UNCHECKED)
    )


def merged(ours: Column, theirs: Column) -> Column:
    """The response's fields, with the revisit's where those are permitted, sorted by name."""
    new = F.filter(ours, lambda p: p["name"].isin(*PERMITTED))
    kept = F.filter(theirs, lambda p: ~F.exists(new, lambda q: q["name"] == p["name"]))
    return F.array_sort(F.concat(kept, new))


def latest_before(asked: DataFrame, offered: DataFrame, slices: int = SLICES) -> DataFrame:
    """(key, ts, record_id) of both → asked rows with original_id: of the latest offered row of the key before ts.

    Equal times: the offered row with the largest id counts, and a row at the asked time is not before it. Null
    keys or times match nothing.
    """
    both = asked.select("key", "ts", "record_id", F.lit(False).alias("offer")).unionByName(
        offered.where("key IS NOT NULL AND ts IS NOT NULL").select("key", "ts", "record_id", F.lit(True).alias("offer"))
    )
    cuts = F.array(*[F.lit(k / slices) for k in range(1, slices)])
    bounds = both.agg(F.percentile_approx("ts", cuts, 1000).alias("b")).first()["b"] or []  # at most `slices` numbers
    edges = F.array(*[F.lit(b).cast("long") for b in sorted(set(bounds))]).cast("array<long>")
    both = both.withColumn("slice", F.coalesce(F.size(F.filter(edges, lambda b: b <= F.col("ts"))), F.lit(0)))
    offer = F.when(F.col("offer"), F.struct("ts", "record_id"))

    ends = both.where("offer").groupBy("key", "slice").agg(F.max(F.struct("ts", "record_id")).alias("end"))
    asked_slices = both.where("NOT offer AND key IS NOT NULL").select("key", "slice").distinct()
    steps = asked_slices.join(ends, ["key", "slice"], "full_outer")
    earlier = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = steps.select("key", "slice", F.last("end", True).over(earlier).alias("carried"))

    order = Window.partitionBy("key", "slice").orderBy("ts", "offer", "record_id").rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("last", F.last(offer, True).over(order)).where("NOT offer")
    found = inside.join(carried, ["key", "slice"], "left")
    original = F.when(F.col("ts").isNotNull() & F.col("key").isNotNull(), F.coalesce("last", "carried")["record_id"])
    return found.select("key", "ts", "record_id", original.alias("original_id"))


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit record: what it stands for.

    ``records``: record_id long, url, ts long, kind ('response' or 'revisit'), status int, headers map of strings.
    Full responses have status 200. Columns: record_id, canonical_url, ts, original_id, outcome and, where it is
    'resolved', headers: the response's fields with the permitted ones of the revisit.

    A null URL, time or kind, or no earlier response: 'no_original'. No common validator: 'unchecked'. Null
    headers have no fields. A revisit that is repeated gives a row each; a repeated response counts once. Other columns are dropped. An empty table gives no rows.
    """
    rows = records.select(
        F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url")).alias("key"), F.col("ts").cast("long").alias("ts"),
        "kind", "status", _fields(F.col("headers")).alias("fields"),
    )
    # Written once: URLs and headers are read by several joins.
    rows = materialize(rows.where("kind = 'revisit' OR kind = 'response' AND status = 200 AND record_id IS NOT NULL"), "archive")
    full = rows.where("kind = 'response'")
    revisits = rows.where("kind = 'revisit'")
    matched = latest_before(revisits.select("key", "ts", "record_id").distinct(), full)
    matched = matched.select(F.col("record_id").alias("_id"), F.col("key").alias("_key"), F.col("ts").alias("_ts"), "original_id")
    same = F.col("record_id").eqNullSafe(F.col("_id")) & F.col("key").eqNullSafe(F.col("_key")) & F.col("ts").eqNullSafe(F.col("_ts"))
    stored = full.select(F.col("record_id").alias("original_id"), F.col("fields").alias("theirs")).dropDuplicates(["original_id"])
    out = materialize(revisits.join(matched, same, "left").drop("_id", "_key", "_ts"), "matched")
    # Revisits without an original take no part in the join: their null would be its hottest key.
    none = out.where("original_id IS NULL").withColumn("theirs", F.lit(None).cast(stored.schema["theirs"].dataType))
    out = out.where("original_id IS NOT NULL").join(stored, "original_id", "left").unionByName(none)
    said = F.when(F.col("original_id").isNull(), MISSING).otherwise(outcome(F.col("fields"), F.col("theirs")))
    return out.select(
        "record_id", F.col("key").alias("canonical_url"), "ts", "original_id", said.alias("outcome"),
        F.when(said == RESOLVED, merged(F.col("fields"), F.col("theirs"))).alias("headers"),
    )


#: URL that every page's records also ask for.
FRONT = "https://front.example/"


def records_of(pages: DataFrame) -> DataFrame:
    """Archive records for the given pages: three responses and three later conditional requests for each.

    Two of either are for the page's URL, the last for FRONT, which so has a third of all records. The content's tag changes
    with every second response. The page's length decides statuses, headers and when requests follow, so that all outcomes
    occur and the latest of several earlier responses has to be found.
    """
    n = F.coalesce(F.length("html"), F.lit(0))
    digest = F.md5(F.coalesce("html", F.lit("")))
    every = pages.select("page_id", "url", n.alias("n"), digest.alias("digest"), F.explode(F.array(*[F.lit(k) for k in range(6)])).alias("_k"))
    k, request = F.col("_k") % 3, F.col("_k") >= 3
    url = F.when(k == 2, FRONT).when(request, F.concat("url", F.lit("#again"))).otherwise(F.col("url"))
    ts = F.col("page_id") + 40 * k + F.when(request, 1 + F.col("n") % 50).otherwise(0)
    mark = F.concat_ws("-", "digest", (k / 2).cast("int").cast("string"))
    tag = F.when(F.col("n") % 5 == 0, F.lit(None)).when(F.col("n") % 7 == 0, F.lit('"other"')).otherwise(F.concat(F.lit('W/"'), mark, F.lit('"')))
    length = F.col("n").cast("string")
    headers = F.when(
        request,
        F.create_map(F.lit("ETag"), tag, F.lit("date"), ts.cast("string"), F.lit("Content-Length"), F.lit("0"), F.lit("Cache-Control"), F.lit("max-age=60")),
    ).otherwise(
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), length, F.lit("ETag"), F.concat(F.lit('"'), mark, F.lit('"')),
            F.lit("Date"), ts.cast("string"), F.lit("Server"), F.lit("archive"),
        )
    )
    status = F.when(request, 304).when((F.col("n") + k) % 11 == 0, 404).otherwise(200)
    return every.select((F.col("page_id") * 6 + F.col("_k")).alias("record_id"), url.alias("url"), ts.alias("ts"), F.when(request, "revisit").otherwise("response").alias("kind"), status.alias("status"), headers.alias("headers"))
