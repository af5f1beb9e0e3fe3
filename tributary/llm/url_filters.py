"""URL filters as a temporal join: each capture against the list entries of its fetch time.

A list entry says that from a moment on a pattern is listed, or no longer listed. The
entries of a pattern become validity intervals that follow each other, and an as-of join
finds the one that holds when a capture was fetched. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from tributary.llm.names import quoted, unused
from tributary.operators.aggregates import collapse
from tributary.sources.scratch import stored

#: Intervals of a pattern that share a time bucket, on average.
PER_BUCKET = 16
#: Entries of a pattern that share a segment of its history, on average.
PER_SEGMENT = 256


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port or a final dot; NULL where there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    host = F.regexp_replace(host, r"\.$", "")
    return F.when(host != "", host)


def lookup_keys(url: Column, host: Column) -> Column:
    """Patterns that could list a capture: its URL without fragment, its host, its domains.

    Keys carry their scope, as in ``url:``, ``host:`` and ``domain:``. A domain entry holds
    for the host itself and for everything under it.
    """
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.concat(F.lit("domain:"), F.concat_ws(".", F.slice(labels, -k, k))),
    )
    whole = F.array(F.concat(F.lit("url:"), F.regexp_replace(url, "#.*$", "")), F.concat(F.lit("host:"), host))
    keys = F.concat(whole, F.coalesce(domains, F.array().cast("array<string>")))
    return F.array_distinct(F.filter(keys, lambda key: key.isNotNull()))


def validity(entries: DataFrame) -> DataFrame:
    """Entries (pattern, at, listed, entry_id) as intervals: pattern, start, end, entry_id.

    An entry holds until the pattern's next one; the last has no end. Of entries for one
    pattern at one moment the one with the largest id counts. Intervals in which the
    pattern is not listed are dropped after they have ended the ones before. Entries with
    a null in pattern, time or ``listed`` are ignored.

    A pattern's history is cut into segments of time, so that a popular pattern is not one
    task's work. Inside a segment an entry ends where the next begins; the last one ends
    where the next segment with entries begins, which is taken from one row per segment.
    """
    usable = entries.where("pattern is not null and at is not null and listed is not null")
    last = usable.groupBy("pattern", "at").agg(F.max(F.struct("entry_id", "listed")).alias("e"))
    last = stored(last.select("pattern", "at", "e.entry_id", "e.listed"), "entries")
    reach = collapse(last, "pattern", t0=F.min("at"), t1=F.max("at"), n=F.count(F.lit(1)))
    width = F.floor((F.col("t1") - F.col("t0")) / F.ceil(F.col("n") / PER_SEGMENT)) + 1
    reach = stored(reach.select("pattern", "t0", width.alias("width")), "reach")
    cut = last.join(reach, "pattern").select(*last.columns, F.floor((F.col("at") - F.col("t0")) / F.col("width")).alias("segment"))
    cut = stored(cut, "segments")
    begins = cut.groupBy("pattern", "segment").agg(F.min("at").alias("at"))
    following = F.lead("at").over(Window.partitionBy("pattern").orderBy("segment"))
    begins = stored(begins.select("pattern", "segment", following.alias("after")), "begins")
    inside = F.lead("at").over(Window.partitionBy("pattern", "segment").orderBy("at"))
    spans = cut.withColumn("inside", inside).join(begins, ["pattern", "segment"])
    return spans.where("listed").select("pattern", F.col("at").alias("start"), F.coalesce("inside", "after").alias("end"), "entry_id")


def active_entries(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """Pairs of a distinct capture (url, fetched_at) and an entry active at its time.

    Both sides are keyed by pattern and time bucket. How finely time is cut depends on the
    pattern's number of intervals: a pattern with many changes has many buckets, so that
    a popular host's captures spread over as many keys and meet about PER_BUCKET intervals
    each. A pattern with few changes has one bucket, and then its intervals are the small
    side, next to which adaptive execution can split the captures. For that the intervals
    are stored first: on top of an aggregate or window of the same stage it could not.
    """
    spans = stored(validity(entries), "spans")
    shape = collapse(
        spans, "pattern", t0=F.min("start"), t1=F.max("start"), buckets=F.ceil(F.count(F.lit(1)) / PER_BUCKET)
    ).withColumn("width", F.floor((F.col("t1") - F.col("t0")) / F.col("buckets")) + 1)
    shape = stored(shape, "shape")

    def bucket(moment: Column) -> Column:
        return F.least(F.floor((moment - F.col("t0")) / F.col("width")), F.col("buckets") - 1)

    cut = spans.join(shape, "pattern").withColumn(
        "bucket", F.explode(F.sequence(bucket(F.col("start")), F.coalesce(bucket(F.col("end")), F.col("buckets") - 1)))
    ).select("pattern", "bucket", "start", "end", "entry_id")
    seen = captures.select(F.col(quoted(url_col)).alias("url"), F.col(quoted(time_col)).cast("long").alias("fetched_at")).distinct()
    keyed = seen.withColumn("pattern", F.explode(lookup_keys(F.col("url"), host_of(F.col("url")))))
    placed = keyed.join(shape, "pattern").where(F.col("fetched_at") >= F.col("t0"))
    placed = placed.select("url", "fetched_at", "pattern", bucket(F.col("fetched_at")).alias("bucket"))
    holds = (F.col("fetched_at") >= F.col("start")) & (F.col("end").isNull() | (F.col("fetched_at") < F.col("end")))
    return placed.join(cut, ["pattern", "bucket"]).where(holds).select("url", "fetched_at", "pattern", "entry_id")


def filter_urls(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """``captures`` with ``blocked``, ``n_active`` and ``first_entry`` (smallest active id).

    Times are whole seconds. A capture without an URL, host or time is not blocked. Every
    row stays, repeated ones too. Columns of these names in ``captures`` are replaced, all
    others pass, whatever their names. Captures without an URL or time take no part in the
    join, and those of a frequent URL can be split among tasks there.
    """
    active = active_entries(captures, entries, url_col, time_col)
    captures = captures.drop("blocked", "n_active", "first_entry")
    url, moment = F.col(quoted(url_col)), F.col(quoted(time_col)).cast("long")
    names = unused(captures, "url_", "at_", "n_", "e_")
    verdict = collapse(active, ["url", "fetched_at"], n=F.count(F.lit(1)), e=F.min("entry_id"))
    verdict = verdict.toDF(*names)
    known = url.isNotNull() & moment.isNotNull()
    same = (url == F.col(names[0])) & (moment == F.col(names[1]))
    none = [F.lit(None).cast("long").alias(name) for name in names[2:]]
    judged = captures.where(known).join(verdict, same, "left").drop(*names[:2])
    judged = judged.unionByName(captures.where(~known).select("*", *none))
    n_active = F.coalesce(names[2], F.lit(0)).cast("long")
    columns = {"n_active": n_active, "first_entry": F.col(names[3]), "blocked": n_active > 0}
    return judged.withColumns(columns).drop(*names[2:])


def captures_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a fetch time within the thirty days of ``events``, spread by page id."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return pages.withColumn("fetched_at", F.expr("1704067200 + pmod(page_id * 7919, 2592000)"))


def entries_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated list made of ``events``: each event lists or delists the page of its user id.

    ``view`` lists the host's last two labels as a domain, ``purchase`` the host, ``signup``
    the URL; ``click`` delists the domain and the host, ``error`` the URL.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    # Ids are unique in pages, so an event meets one page at most.
    joined = events.join(pages, events.user_id == pages.page_id).withColumn("host", host_of(F.col("url")))
    domain = F.concat(F.lit("domain:"), F.substring_index("host", ".", -2))
    host, url = F.concat(F.lit("host:"), F.col("host")), F.concat(F.lit("url:"), F.regexp_replace("url", "#.*$", ""))
    kind = F.col("event_type")
    patterns = (
        F.when(kind == "view", F.array(domain))
        .when(kind == "purchase", F.array(host))
        .when(kind == "click", F.array(domain, host))
        .otherwise(F.array(url))
    )
    return joined.select(
        F.explode(patterns).alias("pattern"),
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias("at"),
        kind.isin("view", "purchase", "signup").alias("listed"),
        F.col("event_id").alias("entry_id"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against the entries active when they were fetched."""
    found = filter_urls(captures_of(spark, sf_dir), entries_of(spark, sf_dir))
    return found.select("page_id", host_of(F.col("url")).alias("host"), "fetched_at", "n_active", "first_entry", "blocked")


ORACLE_SQL = r"""
WITH hosted AS (
  SELECT page_id, url, nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\.$', ''), '') AS host,
         regexp_replace(url, '#.*$', '') AS plain
  FROM pages
), captures AS (
  SELECT *, 1704067200 + (page_id * 7919) % 2592000 AS fetched_at FROM hosted
), raw AS (
  SELECT event_id AS entry_id, CAST(floor(epoch(ts)) AS BIGINT) AS since, event_type,
         event_type IN ('view', 'purchase', 'signup') AS listed,
         'domain:' || array_to_string(string_split(host, '.')[-2:], '.') AS domain_key,
         'host:' || host AS host_key, 'url:' || plain AS url_key
  FROM events JOIN hosted ON user_id = page_id
), entries AS (
  SELECT domain_key AS pattern, since, listed, entry_id FROM raw WHERE event_type IN ('view', 'click')
  UNION ALL SELECT host_key, since, listed, entry_id FROM raw WHERE event_type IN ('purchase', 'click')
  UNION ALL SELECT url_key, since, listed, entry_id FROM raw WHERE event_type IN ('signup', 'error')
), last AS (
  SELECT pattern, since, arg_max(listed, entry_id) AS listed, max(entry_id) AS entry_id
  FROM entries WHERE pattern IS NOT NULL AND since IS NOT NULL GROUP BY pattern, since
), spans AS (
  SELECT *, lead(since) OVER (PARTITION BY pattern ORDER BY since) AS until FROM last
), keyed AS (
  SELECT page_id, fetched_at, unnest(list_distinct(['url:' || plain, 'host:' || host] ||
         list_transform(range(1, len(string_split(host, '.')) + 1), lambda k: 'domain:' || array_to_string(string_split(host, '.')[-k:], '.')))) AS pattern
  FROM captures
), hits AS (
  SELECT page_id, count(*) AS n, min(entry_id) AS e
  FROM keyed JOIN spans USING (pattern)
  WHERE listed AND fetched_at >= since AND (until IS NULL OR fetched_at < until) GROUP BY page_id
)
SELECT c.page_id, c.host, c.fetched_at, coalesce(n, 0) AS n_active, e AS first_entry, coalesce(n, 0) > 0 AS blocked
FROM captures c LEFT JOIN hits USING (page_id)
"""
