"""Trend rows on events, HTML on pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import html as H
from tidemark.functions import trends as R
from tidemark.operators.query import tagged_union
from tidemark.plans.registry import query

NOW = "2025-02-18 12:56:08"
NUM = "CAST(regexp_extract(started, '([0-9]+)', 1) AS INTEGER)"
START = f"""CASE WHEN started LIKE '%hours%' THEN TIMESTAMP '{NOW}' - to_hours({NUM}) ELSE TIMESTAMP '{NOW}' - to_minutes({NUM}) END"""


def now():
    return F.lit(NOW).cast("timestamp_ntz")


@query("f5", """SELECT event_id, (1 + event_id % 9) * CASE event_id % 3 WHEN 0 THEN 1000 WHEN 1 THEN 1000000 ELSE 100 END AS volume
FROM trendv""", using=("trendv",))
def f5(t):
    return t.fixture("trendv").select("event_id", R.parse_volume("volume").alias("volume"))


@query("f6", f"SELECT event_id, {START} AS time_start FROM trendv", using=("trendv",))
def f6(t):
    return t.fixture("trendv").select("event_id", R.relative_time("started", now()).alias("time_start"))


@query("f7", f"""SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN {START} + to_hours(CAST(1 + event_id % 11 AS INTEGER)) END AS time_end
FROM trendv""", using=("trendv",))
def f7(t):
    return t.fixture("trendv").select("event_id", R.end_time(R.relative_time("started", now()), "lasted").alias("time_end"))


@query("f8", "SELECT event_id, event_id % 4 = 0 AS is_active FROM trendv", using=("trendv",))
def f8(t):
    return t.fixture("trendv").select("event_id", R.is_active("lasted").alias("is_active"))


@query("f9", r"""SELECT event_id, regexp_replace(name || ' · ' || volume, '[^\p{L}\p{N} .,-]', '', 'g') AS name FROM trendv""",
       using=("trendv",))
def f9(t):
    dirty = F.concat("name", F.lit(" · "), "volume")
    return t.fixture("trendv").select("event_id", R.strip_special(dirty).alias("name"))


@query("f10", """SELECT event_id, CAST(3 AS INTEGER) AS n, 'a, b, c' || event_id % 7 AS similar_names FROM trendv""", using=("trendv",))
def f10(t):
    names = R.split_list(F.concat("similar_names", F.lit(", ,")))
    return t.fixture("trendv").select("event_id", F.size(names).alias("n"), R.join_list(names).alias("similar_names"))


@query("f11", """SELECT event_id, CASE WHEN output = 'click' THEN 'games, sport' WHEN output = 'view' THEN 'health' ELSE 'other' END
AS categories FROM ev""", using=("ev",))
def f11(t):
    given = F.expr("""CASE output WHEN 'click' THEN array('games', 'none', 'sport') WHEN 'view' THEN array(output, 'health')
                      WHEN 'error' THEN CAST(NULL AS array<string>) ELSE array(output) END""")
    return t.fixture("ev").select("event_id", R.join_list(R.valid_categories(given)).alias("categories"))


@query("f12", """SELECT event_id, CAST(i - 1 AS INTEGER) AS pos, p[i] AS point FROM (
  SELECT event_id, p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT event_id, [-10, event_id % 5, user_id, 128] AS p FROM events))""")
def f12(t):
    series = F.from_json(F.expr("concat('[-10, ', event_id % 5, ', ', user_id, ', 128]')"), "array<bigint>")
    return t.events.select("event_id", F.posexplode(series).alias("pos", "point"))


GEOS = {"view": ("US", 4), "click": ("US", 24), "purchase": ("BE", 4), "error": ("BE", 24)}


@query("x2", "SELECT CASE WHEN event_type IN ('view', 'click') THEN 'US' WHEN event_type IN ('purchase', 'error') THEN 'BE' ELSE 'NL' END AS geo, "
             "CASE WHEN event_type IN ('view', 'purchase') THEN 4 WHEN event_type IN ('click', 'error') THEN 24 ELSE 48 END AS hours, event_id FROM events")
def x2(t):
    parts = {tags: t.events.filter(F.col("event_type") == kind).select("event_id") for kind, tags in GEOS.items()}
    parts["NL", 48] = t.events.filter(~F.col("event_type").isin(*GEOS)).select("event_id")
    return tagged_union(parts, ("geo", "hours"))


def no_element(column: str, name: str) -> str:
    return f"regexp_replace({column}, '(?is)<{name}\\b[^>]*>.*?</{name}\\s*>', '', 'g')"


PLAIN = no_element(no_element("html", "script"), "style")


@query("f13", f"SELECT page_id, {PLAIN} AS html FROM pages")
def f13(t):
    return t.pages.select("page_id", H.html_remove(H.html_remove("html", "script"), "style").alias("html"))


@query("f14", f"SELECT page_id, regexp_replace({PLAIN}, '<([a-zA-Z][a-zA-Z0-9:-]*)\\s[^>]*>', '<\\1>', 'g') AS html FROM pages")
def f14(t):
    plain = H.html_remove(H.html_remove("html", "script"), "style")
    return t.pages.select("page_id", H.html_strip_attrs(plain).alias("html"))


@query("f15", r"""SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<ul\b[^>]*>.*?</ul\s*>')
  THEN '<html>' || regexp_extract(html, '(?is)<ul\b[^>]*>(.*?)</ul\s*>', 1) || '</html>' END AS html FROM pages""")
def f15(t):
    return t.pages.select("page_id", H.html_element_nested("html", "ul").alias("html"))


@query("m3", f"SELECT page_id, regexp_replace({PLAIN}, '<([a-zA-Z][a-zA-Z0-9:-]*)\\s[^>]*>', '<\\1>', 'g') AS html FROM pages")
def m3(t):
    return t.pages.select("page_id", H.html_clean("html", ["script", "style"]).alias("html"))
