"""URL filter: host-suffix x path-prefix expressions, hash-prefix equi-join, digest check.

A rule (host, path, action) fits a URL if the URL's host is the rule's host or
one of its subdomains and the URL's path starts with the rule's path. A URL is
expanded into the few expressions ``host suffix + path prefix`` that a rule
could have, each is hashed, and rules are found by an equi-join on the first
four digest bytes; the full digest and the rest of the path are then compared.
The longest fitting rule wins (ties: longer host, then block, then rule text).

Expressions longer than any rule has are never built, which loses nothing, so a
URL of a million slashes costs no more than the longest rule.

Cases: a null URL, or one without ``://``, has an empty host and path and no
rule; an empty rule table gives every URL the default verdict; repeated rows
stay; a null or repeated page id has no effect, as rows are matched by URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, table

#: Production rules: host, path, action.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
DEFAULT = "allow"
#: Hex digits of the digest in the equi-join key (four bytes).
SHORT = 8


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, action string")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL, as the module's docstring says."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.concat(url, F.lit("")), "://", 1))
    rest = F.coalesce(F.when(rest.isNotNull(), F.substr(url, F.length(rest) + 4)), F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _cut(path: Column) -> Column:
    """A path up to its last slash: the part of a rule's path that is hashed."""
    return F.regexp_extract(path, r"^(.*/)?", 0)


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` with host, path, rule and verdict (columns of these names are replaced)."""
    r = rules.where("host is not null and path is not null").select(
        F.lower("host").alias("rule_host"), F.col("path").alias("rule_path"), "action")
    r = r.withColumn("digest", F.sha2(F.concat("rule_host", _cut(F.col("rule_path"))), 256))
    r = r.withColumn("short", F.substring("digest", 1, SHORT))
    longest = r.agg(F.coalesce(F.max(F.length(_cut(F.col("rule_path")))), F.lit(0)),
                    F.coalesce(F.max(F.size(F.split("rule_host", r"\."))), F.lit(0))).first()
    path_len, labels = int(longest[0]), max(1, int(longest[1]))

    host, path = url_parts(F.col(url))
    keep = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*[F.col(c).alias(f"_page_{c}") for c in keep], host.alias("host"), path.alias("path"))

    parts = F.split("host", r"\.")
    n = F.size(parts)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(labels))),
                           lambda k: F.concat_ws(".", F.slice(parts, n - k + 1, k)))
    pieces = F.split(F.substring("path", 1, path_len), "/")
    prefixes = F.transform(F.sequence(F.lit(0), F.size(pieces) - 1),
                           lambda k: F.when(k == 0, "").otherwise(F.concat(F.concat_ws("/", F.slice(pieces, 1, k)), F.lit("/"))))
    found = (
        rows.select("host", "path").distinct()
        .withColumn("suffix", F.explode(suffixes))
        .withColumn("prefix", F.explode(prefixes))
        .withColumn("url_digest", F.sha2(F.concat("suffix", "prefix"), 256))
        .withColumn("url_short", F.substring("url_digest", 1, SHORT))
        .join(r, F.col("url_short") == F.col("short"))
        .where((F.col("url_digest") == F.col("digest")) & F.startswith("path", "rule_path"))
    )
    name = F.concat("rule_host", "rule_path")
    rank = F.struct(F.length(name), F.length("rule_host"), (F.col("action") == "block").cast("int"), name)
    best = found.groupBy("host", "path").agg(F.max_by(F.struct(name.alias("rule"), "action"), rank).alias("_best"))
    return rows.join(best, ["host", "path"], "left").select(
        *[F.col(f"_page_{c}").alias(c) for c in keep], "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce("_best.action", F.lit(default)).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")


_REST = "case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end"
ORACLE = f"""
with rules(h, p, action) as (values {", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES)}),
u as (
  select page_id, row_number() over () as rid,
         translate(regexp_extract({_REST}, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1) as path
  from pages),
m as (
  select u.rid, r.h || r.p as rule, r.action,
         row_number() over (partition by u.rid order by length(r.h || r.p) desc, length(r.h) desc) as k
  from u join rules r on (u.host = r.h or ends_with(u.host, '.' || r.h)) and starts_with(u.path, r.p))
select u.page_id, u.host, u.path, m.rule, coalesce(m.action, '{DEFAULT}') as verdict
from u left join m on m.rid = u.rid and m.k = 1
"""
