"""Operator 1: URL filters by a temporal list join.

Dated list entries (add or remove a pattern, under a category) become validity intervals; each capture is judged by the
entries that were active when it was fetched. A pattern is a host with all its subdomains, or a host with the leading
segments of a path. Both sides of the join carry (pattern, epoch) as an equality key: a capture looks up every suffix of
its host's labels and every prefix of its path's segments, and intervals are laid out over epochs of EPOCH_DAYS days, so
a pattern with a long history or a third of all captures spreads over many tasks. Hosts are judged once a day, however
many captures they have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.common import boxed, kept, own, unboxed

EPOCH_DAYS = 64
TOP_PARTS = 64  # a pattern of one label (half of all hosts may end in it) is split into so many parts
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#][^?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and dots at its end; '' where there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.+$", "")


def prefix_of(url: Column) -> Column:
    """host/first-segment, or '' where the path is empty."""
    first = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)
    return F.when(first == "", "").otherwise(F.concat(host_of(url), F.lit("/"), first))


def tail_of(url: Column, labels: int) -> Column:
    """The last so many labels of the host; '' where it has fewer."""
    return F.regexp_extract(host_of(url), r"([^.]+" + r"\.[^.]+" * (labels - 1) + ")$", 1)


def site_of(url: Column) -> Column:
    """The host, or host/path without query and fragment, where the path's first segment is not empty; null without either."""
    path = F.regexp_extract(url, PATH, 1)
    return F.nullif(F.when(path == "", host_of(url)).otherwise(F.concat(host_of(url), F.lit("/"), path)), F.lit(""))


def suffixes(host: Column) -> Column:
    """a.b.c: a.b.c, b.c and c."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def prefixes(site: Column) -> Column:
    """h/a/b: h/a and h/a/b; none of a host alone."""
    parts = F.split(site, "/")
    return F.transform(F.filter(F.sequence(F.lit(1), F.size(parts)), lambda i: i > 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def intervals(events: DataFrame) -> DataFrame:
    """events(pattern, day, action, category) to (pattern, category, valid_from, valid_to): the spans [from, to) for which a pattern is listed; a null to is open.

    Where events have a column `list`, each (list, category, pattern) is an entry with a history of its own, so what one
    list does to a pattern leaves the others' entries alone, and spans of one pattern may overlap. Without it all events
    are one list, in which a pattern has one entry at a time and a new category replaces the old one.
    An entry's events hold until its next event. Of several on one day, the last by (action, category) holds, so
    repeated events change nothing. Events with a null pattern or day are not entries and are dropped.
    """
    entry = ["list", "category", "pattern"] if "list" in events.columns else ["pattern"]
    events = events.where(F.col("pattern").isNotNull() & F.col("day").isNotNull() & (F.col("pattern") != ""))
    daily = events.select(*entry, "day", F.struct("action", "category").alias("e")).groupBy(*entry, "day").agg(F.max("e").alias("e"))
    nxt = F.lead("day").over(Window.partitionBy(*entry).orderBy("day"))
    spans = daily.select("pattern", F.col("e.action").alias("action"), F.col("e.category").alias("category"), F.col("day").alias("valid_from"), nxt.alias("valid_to"))
    return spans.where("action = 'add'").select("pattern", "category", "valid_from", "valid_to")


def temporal_list_join(captures: DataFrame, events: DataFrame, url: str = "url", day: str = "fetch_day") -> DataFrame:
    """Adds list_level, list_pattern, list_category and listed_since to every capture: the most specific entry active on its day, or nulls.

    Patterns are matched as they are written: hosts in lower case, without user, port and dot at the end, which captures'
    hosts lose. Of several entries of a pattern, the latest one, then the last category. A null or malformed URL, or a
    null day, matches nothing. Every row of captures is kept, repeated ones too; input columns of the added names, in any
    case, are replaced. Intervals are laid out over the epochs in which there are captures, so days may lie anywhere.
    Without events, every capture has nulls; without captures there are no rows. Very long URLs cost their length, and a
    host or path of many parts a look-up for each.
    """
    keep = kept(captures, "list_level", "list_pattern", "list_category", "listed_since")
    epoch = F.expr(f"on div {EPOCH_DAYS}")
    seen = captures.select(boxed(keep), site_of(own(url)).alias("site"), host_of(own(url)).alias("host"), own(day).alias("on"))
    occur = seen.agg(F.collect_set(epoch).alias("epochs"))
    within = lambda e: (e >= F.expr(f"valid_from div {EPOCH_DAYS}")) & (F.col("valid_to").isNull() | (e <= F.expr(f"(valid_to - 1) div {EPOCH_DAYS}")))
    spans = intervals(events).crossJoin(F.broadcast(occur)).select("pattern", "category", "valid_from", "valid_to", F.explode(F.filter("epochs", within)).alias("epoch"))
    wide = ~F.contains("pattern", F.lit(".")) & ~F.contains("pattern", F.lit("/"))
    spans = spans.withColumn("part", F.explode(F.when(wide, F.sequence(F.lit(0), F.lit(TOP_PARTS - 1))).otherwise(F.array(F.lit(0)))))

    def judged(name: str, keys) -> DataFrame:
        """(name, on, hit) of every distinct value and day that an entry under one of its keys was active on: the longest key, then the latest entry."""
        looks = seen.select(name, "on", epoch.alias("epoch")).where((F.coalesce(name, F.lit("")) != "") & F.col("on").isNotNull()).distinct()
        looks = looks.select(name, "on", "epoch", F.explode(keys(F.col(name))).alias("pattern"))
        looks = looks.withColumn("part", F.when(wide, F.pmod(F.hash(name, "on"), F.lit(TOP_PARTS))).otherwise(0))
        met = looks.join(spans, ["pattern", "epoch", "part"]).where((F.col("on") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("on") < F.col("valid_to"))))
        return met.groupBy(name, "on").agg(F.max(F.struct(F.length("pattern").alias("n"), "valid_from", "category", "pattern")).alias(f"{name}_hit"))

    out = seen.join(judged("site", prefixes), ["site", "on"], "left").join(judged("host", suffixes), ["host", "on"], "left")
    hit = F.coalesce("site_hit", "host_hit")
    level = F.when(F.col("site_hit").isNotNull(), "prefix").when(hit["pattern"] == F.col("host"), "host").when(hit.isNotNull(), "domain")
    return out.select(*unboxed(keep), level.alias("list_level"), hit["pattern"].alias("list_pattern"), hit["category"].alias("list_category"), hit["valid_from"].alias("listed_since"))


def fetch_day(page_id: Column) -> Column:
    """The tables carry no fetch time; captures are dated by their id over four years of days."""
    return F.pmod(page_id * 7919, F.lit(1461)).cast("int")


def list_events(pages: DataFrame) -> DataFrame:
    """The dated lists against which the pages are judged, drawn up from the hosts and paths that occur; each has histories of its own.

    List `ads`: every name of three labels, from a day set by its smallest page id for 400 days. List `threats`: every
    host whose smallest page id is even, as 'spam' for 90 days and as 'malware' from 290 days after that on. List
    `adult`: every first path segment whose smallest page id divides by 3, for 300 days. List `parked`: names of two
    labels and of four labels whose smallest page id divides by 4, for 30 days, and again 200 days later.
    """
    first = lambda of: pages.select(of.alias("pattern"), "page_id").where("pattern != ''").groupBy("pattern").agg(F.min("page_id").alias("k"))
    event = lambda day, action, category: F.struct(day.cast("int").alias("day"), F.lit(action).alias("action"), F.lit(category).alias("category"))
    base = lambda m: F.pmod(F.col("k") * m, F.lit(1000))
    history = lambda name, df, *events: df.select(F.lit(name).alias("list"), "pattern", F.inline(F.array(*events)))
    url = F.col("url")
    ads = history("ads", first(tail_of(url, 3)), event(base(31), "add", "ads"), event(base(31) + 400, "remove", "ads"))
    threats = history("threats", first(host_of(url)).where("k % 2 = 0"), event(base(57), "add", "spam"), event(base(57) + 90, "remove", "spam"), event(base(57) + 290, "add", "malware"))
    adult = history("adult", first(prefix_of(url)).where("k % 3 = 0"), event(base(83), "add", "adult"), event(base(83) + 300, "remove", "adult"))
    names = first(tail_of(url, 2)).unionByName(first(tail_of(url, 4))).where("k % 4 = 0")
    parked = history("parked", names, *[event(base(17) + d, a, "parked") for d, a in ((0, "add"), (30, "remove"), (200, "add"), (230, "remove"))])
    return ads.unionByName(threats).unionByName(adult).unionByName(parked)


def url_lists_report(pages: DataFrame) -> DataFrame:
    """Each page with the list entry active on its fetch day. Null ids and URLs match nothing; repeated rows stay; an empty table gives no rows."""
    captures = pages.select("page_id", "url", fetch_day(F.col("page_id")).alias("fetch_day"))
    out = temporal_list_join(captures, list_events(pages))
    return out.withColumn("blocked", F.col("list_level").isNotNull())


SQL = rf"""
WITH p AS (
  SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '{HOST}', 1)), '\.+$', '') AS host, regexp_extract(url, '{PATH}', 1) AS path,
         CAST(((page_id * 7919) % 1461 + 1461) % 1461 AS INTEGER) AS fetch_day FROM pages),
n AS (
  SELECT 'ads' AS list, regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) AS pattern, page_id FROM p
  UNION ALL SELECT 'threats', host, page_id FROM p
  UNION ALL SELECT 'adult', CASE WHEN path = '' THEN '' ELSE host || '/' || string_split(path, '/')[1] END, page_id FROM p
  UNION ALL SELECT 'parked', regexp_extract(host, '([^.]+\.[^.]+)$', 1), page_id FROM p
  UNION ALL SELECT 'parked', regexp_extract(host, '([^.]+\.[^.]+\.[^.]+\.[^.]+)$', 1), page_id FROM p),
k AS (SELECT list, pattern, min(page_id) AS k FROM n WHERE pattern <> '' GROUP BY 1, 2),
h(list, every, factor, after, action, category) AS (VALUES
  ('ads', 1, 31, 0, 'add', 'ads'), ('ads', 1, 31, 400, 'remove', 'ads'),
  ('threats', 2, 57, 0, 'add', 'spam'), ('threats', 2, 57, 90, 'remove', 'spam'), ('threats', 2, 57, 290, 'add', 'malware'),
  ('adult', 3, 83, 0, 'add', 'adult'), ('adult', 3, 83, 300, 'remove', 'adult'),
  ('parked', 4, 17, 0, 'add', 'parked'), ('parked', 4, 17, 30, 'remove', 'parked'), ('parked', 4, 17, 200, 'add', 'parked'), ('parked', 4, 17, 230, 'remove', 'parked')),
e AS (SELECT list, category, pattern, (k * factor) % 1000 + after AS day, max(action) AS action FROM k JOIN h USING (list) WHERE k % every = 0 GROUP BY ALL),
spans AS (SELECT *, lead(day) OVER (PARTITION BY list, category, pattern ORDER BY day) AS until FROM e),
live AS (SELECT * FROM spans WHERE action = 'add'),
q AS (
  SELECT page_id, fetch_day, 0 AS kind, unnest(list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.'))) AS pattern FROM p WHERE host <> ''
  UNION ALL
  SELECT page_id, fetch_day, 1, host || '/' || unnest(list_transform(range(1, len(string_split(path, '/')) + 1), lambda i: array_to_string(string_split(path, '/')[1:i], '/'))) FROM p WHERE host <> '' AND path <> ''),
m AS (
  SELECT page_id, max({{'kind': kind, 'n': length(pattern), 'day': day, 'category': category, 'pattern': pattern}}) AS hit
  FROM q JOIN live USING (pattern) WHERE fetch_day >= day AND (until IS NULL OR fetch_day < until) GROUP BY 1)
SELECT p.page_id, url, fetch_day, CASE WHEN hit.kind = 1 THEN 'prefix' WHEN hit.pattern = host THEN 'host' WHEN hit IS NOT NULL THEN 'domain' END AS list_level,
  hit.pattern AS list_pattern, hit.category AS list_category, CAST(hit.day AS INTEGER) AS listed_since, hit IS NOT NULL AS blocked
FROM p LEFT JOIN m USING (page_id)
"""
