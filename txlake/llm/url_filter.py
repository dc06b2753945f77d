"""URL filters with redirect equivalence.

Rules (host, path, verdict) judge a url by its host, the host's parent domains
and the start of its path; the longest rule wins. Urls without a rule take the
decision of their aliases: redirects and canonical links found in the pages,
and the redirects every site makes (scheme, ``www.``/``m.``, tracking parameters,
fragment, trailing slash, ``.html``), are edges of a graph whose connected
components are computed distributedly. In a component an explicit allow goes
before a block; a component without a rule is allowed. A url with a rule of its
own always keeps that verdict. Links may be absolute, without a scheme
(``//host/path``), or relative to the page's host, folder or url. Urls that
differ in a parameter other than a tracking one are different urls.

Cases: a null url, or one without ``://``, has empty host and path, no rule and
no aliases: allowed, whatever its page says; null html has no edges, very long
html and urls are read whole; repeated pages are judged alike; of rules of
equal length the last one wins; an empty table gives an empty result; extra
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import components, scratch

#: (host, path, verdict): fixed values.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, *_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls. The rules are
    a parameter and stand in the expression."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


#: Parameters that tell where a visitor came from, not what is shown.
TRACKING = r"^(utm(_[a-z0-9_]*)?|gclid|fbclid|msclkid|yclid|mc_cid|mc_eid|igshid)(=|\z)"


def query_of(url: Column) -> Column:
    """A url's parameters but for tracking ones, in their order."""
    raw = F.coalesce(F.regexp_extract(url, r"(?s)\A[^?#]*\?([^#]*)", 1), F.lit(""))
    return F.array_join(F.filter(F.split(raw, "&"), lambda p: (p != "") & ~F.regexp_like(F.lower(p), F.lit(TRACKING))), "&")


def site_key(host: Column, path: Column, query: Column) -> Column:
    """The form a site redirects a url's variants to."""
    host = F.regexp_replace(host, r"^(www|m)\.", "")
    key = F.concat(host, F.regexp_replace(path, r"(/|\.html?)+\z", ""))
    return F.when(query == "", key).otherwise(F.concat(key, F.lit("?"), query))


def linked_urls(html: Column) -> Column:
    """What a page redirects to or names as canonical, as written there."""
    # a tag may have its attributes in either order
    link = F.regexp_extract_all(html, F.lit(r"(?is)<link\b[^>]*?\brel\s*=\s*[\"']?canonical\b[^>]*>"), F.lit(0))
    meta = F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*?http-equiv\s*=\s*[\"']?refresh\b[^>]*>"), F.lit(0))
    none = F.array().cast("array<string>")
    hrefs = F.transform(F.coalesce(link, none), lambda t: F.regexp_extract(t, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1))
    targets = F.transform(F.coalesce(meta, none), lambda t: F.regexp_extract(t, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1))
    return F.filter(F.transform(F.concat(hrefs, targets), lambda u: F.replace(u, F.lit("&amp;"), F.lit("&"))), lambda u: u != "")


def _without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` steps taken."""
    steps = F.split(path, "/")
    last = F.element_at(steps, -1)
    taken = F.aggregate(F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0))), F.array().cast("array<string>"), lambda done, s:
                        F.when(s == ".", done).when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(s))))
    folder = F.when(last.isin(".", "..") & (F.size(taken) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(taken, "/"), folder)


def resolved(link: Column, host: Column, path: Column) -> Column:
    """A page's link as an absolute url; null where it leads to no other page
    of the web (a fragment, ``mailto:`` and the like)."""
    base = F.concat(F.lit("http://"), host)
    folder = F.regexp_replace(F.when(path == "", F.lit("/")).otherwise(path), r"[^/]*\z", "")
    tail = F.regexp_extract(link, r"(?s)\A[^?#]*(.*)\z", 1)
    steps = F.regexp_extract(link, r"(?s)\A([^?#]*)", 1)
    return (F.when(F.regexp_like(link, F.lit(r"\A[A-Za-z][A-Za-z0-9+.\-]*://")), link)
            .when(F.startswith(link, F.lit("//")), F.concat(F.lit("http:"), link))
            .when(F.regexp_like(link, F.lit(r"\A([A-Za-z][A-Za-z0-9+.\-]*:|#)")) | (link == ""), F.lit(None).cast("string"))
            .when(F.startswith(link, F.lit("?")), F.concat(base, path, link))
            .when(F.startswith(link, F.lit("/")), F.concat(base, _without_dots(steps), tail))
            .otherwise(F.concat(base, _without_dots(F.concat(folder, steps)), tail)))


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, component for every page."""
    url = F.col("url")
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    base = (pages.select("page_id", url, linked_urls(F.col("html")).alias("links"), host_of(url).alias("host"), path_of(url).alias("path"))
            .withColumn("rule", rule).withColumn("own", verdict)
            .withColumn("key", F.when(F.col("host") != "", site_key(F.col("host"), F.col("path"), query_of(url)))).drop("url"))
    base = scratch(base, "url-base")
    link = base.where("key is not null").select("key", "host", "path", F.explode("links").alias("to"))
    link = link.select("key", resolved(F.col("to"), F.col("host"), F.col("path")).alias("to")).where("to is not null")
    link = (link.select("key", host_of(F.col("to")).alias("host"), path_of(F.col("to")).alias("path"), query_of(F.col("to")).alias("query")).where("host <> ''")
            .withColumn("to", site_key(F.col("host"), F.col("path"), F.col("query"))))
    # a link's target carries its own rule even where no page of it was crawled
    lrule, lverdict = ruled(F.col("host"), F.col("path"), rules)
    marks = base.where("key is not null").select("key", "own").unionByName(link.select(F.col("to").alias("key"), lverdict.alias("own")))
    comps = components(link.select(F.col("key").alias("a"), F.col("to").alias("b")), "url")
    comps = comps.select(F.col("node").alias("key"), "comp")
    rank = F.when(F.col("own") == "allow", 2).when(F.col("own") == "block", 1).otherwise(0)
    # per site key first, then per component: at most one row per distinct key is joined
    per_key = scratch(marks.groupBy("key").agg(F.max(rank).alias("rank")).join(comps, "key", "left")
                      .withColumn("component", F.coalesce("comp", "key")).drop("comp"), "url-keys")
    level = scratch(per_key.groupBy("component").agg(F.max("rank").alias("level")), "url-levels")
    decided = scratch(per_key.select("key", "component").join(level, "component"), "url-decided")
    out = base.drop("links").join(decided, "key", "left")
    taken = F.when(F.col("level") == 1, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("own", taken).alias("verdict"), "component")
