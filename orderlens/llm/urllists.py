"""URL filters by dated lists: validity intervals and an as-of join.

A list is a log of dated entries, each of which adds a domain to the list or takes it off.
Ordered by time (ties by entry_id, the last one counts), the entries of a list and domain
become validity intervals: an entry holds from its time until the next entry of the same list
and domain. A capture is under every domain that its host ends in, whole labels only, and is
judged by the entries that hold at its fetch time, as they were then.

The join is on (domain, month): an interval is laid out over the months in which it holds, so
a domain with a very long log or very many captures is split by time, each capture meets only
the intervals of its month, and what is still uneven AQE splits as a skewed join. Only
DataFrame functions are used.

Defined cases: a capture without fetch time, url or host is under no entry; entries without
time, list or domain never hold; repeated captures give one row each; of several entries that
hold, the longest domain decides, then the list's name; extra columns are ignored; empty
tables give an empty or an unblocked result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from orderlens.llm import common as c

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def domains(name):
    """The host and every domain above it."""
    labels = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """list, domain, entry_id, valid_from, valid_to (null: still valid) of entries that add."""
    log = (entries.select("entry_id", F.col("list_name").alias("list"), F.lower("domain").alias("domain"),
                          "action", F.col("entry_time").alias("valid_from"))
           .filter("list is not null and domain is not null and valid_from is not null"))
    following = F.lead("valid_from").over(Window.partitionBy("list", "domain").orderBy("valid_from", "entry_id"))
    return (log.withColumn("valid_to", following)
            .filter("action = 'add' and (valid_to is null or valid_from < valid_to)").drop("action"))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, url, host, fetched, blocked, n_entries and the deciding list, domain, entry_id,
    valid_from and valid_to for each capture (page_id, url, fetched)."""
    caps = captures.select("page_id", "url", host("url").alias("host"), "fetched").withColumn(
        "_row", F.xxhash64("page_id", "url", "fetched"))
    month = lambda t: F.trunc(F.to_date(t), "month")
    holds = intervals(entries)
    # open intervals end with the captures
    last = caps.agg(F.max("fetched").alias("_last"))
    laid = (holds.crossJoin(F.broadcast(last))  # one row
            .withColumn("_end", F.coalesce(F.least("valid_to", "_last"), F.col("_last")))
            .filter("valid_from <= _end")
            .withColumn("_month", F.explode(F.sequence(month(F.col("valid_from")), month(F.col("_end")),
                                                       F.expr("interval 1 month")))).drop("_last", "_end"))
    near = (caps.filter("host <> '' and fetched is not null").select("_row", "fetched", month(F.col("fetched")).alias("_month"),
                                                                    F.explode(domains(F.col("host"))).alias("domain")))
    met = near.join(laid, ["domain", "_month"]).filter(
        "fetched >= valid_from and (valid_to is null or fetched < valid_to)")
    pick = F.struct((-F.length("domain")).alias("_o"), "list", "domain", "entry_id", "valid_from", "valid_to")
    best = met.distinct().groupBy("_row").agg(F.count("*").alias("n_entries"), F.min(pick).alias("_b"))
    return caps.join(best, "_row", "left").select(
        "page_id", "url", "host", "fetched", F.col("n_entries").isNotNull().alias("blocked"),
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"), F.col("_b.list").alias("list"),
        F.col("_b.domain").alias("domain"), F.col("_b.entry_id").alias("entry_id"),
        F.col("_b.valid_from").alias("valid_from"), F.col("_b.valid_to").alias("valid_to"))


# --- captures and lists of the test tables ----------------------------------------------
def captures_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, fetched at the time of the event whose id is page_id modulo the events."""
    pages, events = c.read(spark, sf_dir, "pages"), c.read(spark, sf_dir, "events")
    n = events.agg(F.count("*").alias("_n"))
    times = events.select(F.col("event_id").alias("_e"), F.col("ts").alias("fetched"))
    return (pages.select("page_id", "url").crossJoin(F.broadcast(n))
            .withColumn("_e", F.col("page_id") % F.greatest("_n", F.lit(1))).join(times, "_e", "left")
            .select("page_id", "url", "fetched"))


def entries_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a list entry about the page numbered 7 times its user: errors and
    purchases put the page's host (for even ids the domain above it) on a list, others take
    it off."""
    pages, events = c.read(spark, sf_dir, "pages"), c.read(spark, sf_dir, "events")
    n = pages.agg(F.count("*").alias("_n"))
    hosts = pages.select(F.col("page_id").alias("_p"), host("url").alias("_host"))
    above = F.regexp_replace("_host", r"^[^.]*\.", "")
    return (events.crossJoin(F.broadcast(n)).withColumn("_p", F.col("user_id") * 7 % F.greatest("_n", F.lit(1)))
            .join(hosts, "_p").select(
                F.col("event_id").alias("entry_id"),
                F.when(F.col("event_id") % 3 == 0, "spam").otherwise("adult").alias("list_name"),
                F.when(F.col("event_id") % 2 == 0, above).otherwise(F.col("_host")).alias("domain"),
                F.when(F.col("event_type").isin("error", "purchase"), "add").otherwise("remove").alias("action"),
                F.col("ts").alias("entry_time")))


def out_times(df: DataFrame) -> DataFrame:
    """df with its three times as text, the same in every time zone setting."""
    text = lambda x: F.date_format(x, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(x)
    return df.select(*[text(x) if x in ("fetched", "valid_from", "valid_to") else x for x in df.columns])


ORACLE_SQL = r"""
WITH host_of AS (
  SELECT page_id, url,
    lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host
  FROM pages),
caps AS (
  SELECT h.page_id, h.url, h.host, e.ts AS fetched
  FROM host_of h LEFT JOIN events e ON e.event_id = h.page_id % (SELECT greatest(count(*), 1) FROM events)),
entries AS (
  SELECT e.event_id AS entry_id, CASE WHEN e.event_id % 3 = 0 THEN 'spam' ELSE 'adult' END AS list,
    CASE WHEN e.event_id % 2 = 0 THEN regexp_replace(h.host, '^[^.]*\.', '') ELSE h.host END AS domain,
    e.event_type IN ('error', 'purchase') AS added, e.ts AS valid_from
  FROM events e JOIN host_of h ON h.page_id = e.user_id * 7 % (SELECT greatest(count(*), 1) FROM pages)
  WHERE e.ts IS NOT NULL),
holds AS (
  SELECT * FROM (
    SELECT *, lead(valid_from) OVER (PARTITION BY list, domain ORDER BY valid_from, entry_id) AS valid_to
    FROM entries) WHERE added),
met AS (
  SELECT c.page_id, c.url, c.fetched, h.list, h.domain, h.entry_id, h.valid_from, h.valid_to
  FROM caps c JOIN holds h ON (c.host = h.domain OR ends_with(c.host, '.' || h.domain))
    AND c.host <> '' AND c.fetched >= h.valid_from AND (h.valid_to IS NULL OR c.fetched < h.valid_to)),
best AS (
  SELECT *, count(*) OVER (PARTITION BY page_id, url) AS n,
    row_number() OVER (PARTITION BY page_id, url ORDER BY length(domain) DESC, list, entry_id) AS k
  FROM met)
SELECT c.page_id, c.url, c.host, strftime(c.fetched, '%Y-%m-%d %H:%M:%S.%f') AS fetched, b.n IS NOT NULL AS blocked,
  coalesce(b.n, 0) AS n_entries, b.list, b.domain, b.entry_id,
  strftime(b.valid_from, '%Y-%m-%d %H:%M:%S.%f') AS valid_from, strftime(b.valid_to, '%Y-%m-%d %H:%M:%S.%f') AS valid_to
FROM caps c LEFT JOIN best b ON b.page_id = c.page_id AND b.url IS NOT DISTINCT FROM c.url AND b.k = 1
"""
