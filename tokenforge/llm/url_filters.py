"""URL rules carried over redirects and canonical links (operator 9).

A rule (host, path, verdict) fits its host and all subdomains where the url's path starts with the rule's; the longest
rule wins.  Pages that a rule fits keep its verdict, so an explicit allow takes precedence.
The others belong to equivalence classes over redirect and canonical-link edges between urls: a class with a blocked
member blocks them, else they are allowed.  Only DataFrame functions are used.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is allowed; the same url
on several pages is one node; an edge with a null end is ignored; a
relative link is resolved against its page's url (not against ``<base>``), and gives no edge where that has no ``://``;
all canonical links and refreshes of a page count, with the references of :data:`ENTITIES` in them read as characters; a hot
url is one row before any edge is shuffled, as edges are made distinct first; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import components, stored, table

#: (host, path, verdict); fixed values.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)?", 1), F.lit(""))


def ruled(df: DataFrame, rules=RULES) -> DataFrame:
    """``df(host, path)`` with ``rule`` and ``rule_verdict`` (null where none fits)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # a later, longer one overrides
        fits = ((F.col("host") == h) | F.endswith(F.col("host"), F.lit("." + h))) & F.startswith(F.col("path"), F.lit(p))
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return df.withColumn("rule", name).withColumn("rule_verdict", verdict)


def resolved(link: Column, url: Column) -> Column:
    """``link`` as it reads from the page at ``url`` (RFC 3986, 5.2); absolute ones stay as they are.

    Null where ``url`` has no ``://`` to resolve by, and for links of other schemes (``mailto:x``).
    """
    scheme = F.regexp_extract(url, r"(?s)^([A-Za-z][A-Za-z0-9+.-]*:)//", 1)
    root = F.regexp_extract(url, r"(?s)^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    at, asked = path(url), F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    own, rest = F.regexp_extract(link, r"(?s)^([^?#]*)", 1), F.regexp_extract(link, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.when(at == "", F.lit("/")).otherwise(F.regexp_extract(at, r"(?s)^(.*/)", 1))
    whole = F.when(F.startswith(own, F.lit("/")), own).otherwise(F.concat(folder, own))

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    parts = F.split(F.substring(whole, 2, 1 << 30), "/")
    clean = F.concat(F.lit("/"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))
    # a path that ends in a dot segment is a folder
    clean = F.when(F.regexp_like(whole, F.lit(r"/\.\.?$")) & ~F.endswith(clean, F.lit("/")), F.concat(clean, F.lit("/"))).otherwise(clean)
    query = F.when(F.startswith(rest, F.lit("?")), rest).otherwise(F.concat(asked, rest))  # of the page, where the link has neither
    return (
        F.when(F.regexp_like(link, F.lit("(?s)^[A-Za-z][A-Za-z0-9+.-]*://")), link)
        .when((root == "") | F.regexp_like(link, F.lit("(?s)^[A-Za-z][A-Za-z0-9+.-]*:")), F.lit(None))
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, link))
        .when(own == "", F.concat(root, at, query))
        .otherwise(F.concat(root, clean, rest))
    )


#: Character references that are read in links; fixed values.
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&#x27;", "'"), ("&#34;", '"'), ("&#47;", "/"),
    ("&#x2f;", "/"), ("&#x2F;", "/"), ("&sol;", "/"), ("&#58;", ":"), ("&colon;", ":"), ("&#61;", "="), ("&equals;", "="), ("&#63;", "?"),
    ("&#38;", "&"), ("&#x26;", "&"), ("&amp;", "&"),
)


def _plain(link: Column) -> Column:
    for name, sign in ENTITIES:  # the sign & comes last, so nothing is read twice
        link = F.replace(link, F.lit(name), F.lit(sign))
    return link


def html_edges(pages: DataFrame) -> DataFrame:
    """Edges ``(src, dst)`` between urls from canonical links and refresh redirects in ``pages(url, html)``."""
    tag = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
    turn = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\bcontent\s*=\s*[\"']?[^\"'>]*?url\s*=\s*([^\"'\s>]+)"
    low = F.lower("html")
    # plain searches come first: few pages need the patterns
    found = pages.where(F.contains(low, F.lit("canonical")) | F.contains(low, F.lit("refresh"))).select(
        F.col("url").alias("src"),
        F.explode(F.array_distinct(F.concat(*(F.regexp_extract_all("html", F.lit(x), F.lit(1)) for x in (tag, turn))))).alias("dst"),
    )
    told = found.where("dst <> ''").withColumn("dst", resolved(_plain(F.col("dst")), F.col("src")))
    return told.where("dst is not null").distinct()


def url_filters(pages: DataFrame, edges: DataFrame, rules=RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages(page_id, url)`` under ``edges(src, dst)`` of urls."""
    judged = ruled(pages.select("page_id", "url").withColumns({"host": host(F.col("url")), "path": path(F.col("url"))}), rules)
    links = edges.where("src is not null and dst is not null and src <> dst").distinct()
    links, _ = stored(links, "url-links")
    if links.isEmpty():
        return judged.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit("allow")).alias("verdict"))
    nodes = components(links, "url-cc").withColumnRenamed("id", "url")
    named = ruled(nodes.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))}), rules)
    blocked = named.groupBy("component").agg(F.max(F.when(F.col("rule_verdict") == "block", 1).otherwise(0)).alias("blocked"))
    aliases = nodes.join(blocked.where("blocked = 1"), "component").select("url").distinct().withColumn("by_alias", F.lit("block"))
    return judged.join(aliases, "url", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", "by_alias", F.lit("allow")).alias("verdict")
    )


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters(pages, html_edges(pages))


def url_filters_over_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator where every page names the next one of its host as canonical: a blocked page blocks its whole host."""
    pages = table(spark, sf_dir, "pages").withColumn("host", host(F.col("url")))
    after = F.lead("url").over(Window.partitionBy("host").orderBy("page_id"))
    link = F.when((F.col("host") != "") & after.isNotNull(), F.concat(F.lit('<link rel="canonical" href="'), F.replace(after, F.lit("&"), F.lit("&amp;")), F.lit('">')))
    linked = pages.select("page_id", "url", F.concat(F.coalesce("html", F.lit("")), F.coalesce(link, F.lit(""))).alias("html"))
    return url_filters(linked, html_edges(linked))


#: For tables whose html has neither canonical links nor refreshes, as RE2 lacks the look-ahead; tests cover those.
OP9_SQL = """
with recursive p as (
  select page_id, url, html, translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as h,
    regexp_extract(url, '^.*?://[^/?#]*(/[^?#]*)?', 1, 's') as q
  from pages),
u as (select page_id, url, html, coalesce(h, '') as host, coalesce(q, '') as path from p),
r(rh, rp, rv) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f as (
  select page_id, arg_max(rh || rp, length(rh || rp)) as rule, arg_max(rv, length(rh || rp)) as rv
  from u join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by page_id)
select u.page_id, u.host, u.path, f.rule, coalesce(f.rv, 'allow') as verdict from u left join f using (page_id)
"""

#: Components over links of a host's pages are its pages.
URL_LINKS_SQL = OP9_SQL.replace(
    "select u.page_id, u.host, u.path, f.rule, coalesce(f.rv, 'allow') as verdict from u",
    "select u.page_id, u.host, u.path, f.rule, coalesce(f.rv, case when u.host <> '' and bool_or(f.rv = 'block') over (partition by u.host) then 'block' end, 'allow') as verdict from u",
)
