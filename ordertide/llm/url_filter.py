"""URL verdicts: longest host-and-path rule, else a list of canonical URLs behind a blocked Bloom filter.

The filter is a table of 256-bit rows, one for ``KEYS`` listed URLs and at most ``BLOCKS``, so it can be
broadcast whatever the size of the list. It passes listed URLs and a few others; only those reach the exact join on
the canonical URL, which removes the false ones.

Defined cases: null URLs and such without ``://`` have an empty host and path and are allowed; an
empty list allows what no rule judges; listed nulls are ignored and repeated ones count once;
repeated pages are judged alike; extra columns pass through, whatever their names, but for those of the result.
"""

from pyspark.sql import functions as F

#: Fixed values of the contract: (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Blocks of four 64-bit words at most, 10 MB in all, and keys for each. A key sets one bit of each word.
BLOCKS, KEYS = 1 << 18, 16
#: Host labels of junk sites, by their beginnings.
JUNK = r"(^|\.)(spam-|casino-|free-bets|cheap-pills|adult-|ads-track)"
#: Query parameters that do not change what a URL names.
TRACKING = r"^(utm_.*|ref|fbclid|gclid)(=.*)?$"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def _part(url, group):
    return F.coalesce(F.regexp_extract(url, _PARTS, group), F.lit(""))


def host_of(url):
    return F.translate(_part(url, 1), _UPPER, _LOWER)


def path_of(url):
    return _part(url, 2)


def canonical(url):
    """Host and path without a trailing slash, and the other query parameters in order; no scheme, no fragment."""
    query = F.array_sort(F.filter(F.split(_part(url, 3), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise("")
    return F.when(F.contains(url, F.lit("://")), F.concat(host_of(url), F.rtrim(path_of(url), F.lit("/")), tail))


def _rule(host, path, rules, value):
    """``value(rule)`` of the longest rule that fits, else null."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])
        out = F.when(fits, value(rule)) if out is None else out.when(fits, value(rule))
    return F.lit(None).cast("string") if out is None else out


def _block(key, blocks):
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def blocks_for(n):
    """Blocks of a filter of n keys: a power of two."""
    return min(BLOCKS, 1 << (max(n, 1) // KEYS).bit_length())


def _bits(key):
    h = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")
    return [F.call_function("shiftleft", one, F.shiftright(h, 6 * i).bitwiseAND(63).cast("int")) for i in range(4)]


def blocked_bloom(keys, column, blocks, tag="_"):
    """block and the words w0 .. w3 of the filter, after ``tag``; one row for each block that is not empty."""
    words = [F.bit_or(bit).alias(f"{tag}w{i}") for i, bit in enumerate(_bits(F.col(column)))]
    return keys.where(F.col(column).isNotNull()).groupBy(_block(F.col(column), blocks).alias(f"{tag}block")).agg(*words)


def judge_urls(pages, listed, rules=RULES):
    """The pages with host, path, rule and verdict; ``listed`` has one column of canonical URLs to block."""
    tag = "_"
    while any(c.startswith(tag) for c in pages.columns):  # temporary columns clash with none
        tag += "_"
    key, said, at, maybe, known, inside = (f"{tag}{c}" for c in ("key", "said", "at", "maybe", "listed", "in"))
    listed = listed.toDF(known).where(F.col(known).isNotNull()).distinct()
    blocks = blocks_for(listed.count())
    url = pages["url"]
    extra = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*(pages[c] for c in extra), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias(key))
    rows = rows.withColumns(
        {
            "rule": _rule(F.col("host"), F.col("path"), rules, lambda r: r[0] + r[1]),
            said: _rule(F.col("host"), F.col("path"), rules, lambda r: r[2]),
            at: _block(F.col(key), blocks),
        }
    )
    bloom = blocked_bloom(listed, known, blocks, tag)
    rows = rows.join(F.broadcast(bloom), F.col(at) == F.col(f"{tag}block"), "left")
    hit = F.lit(True)
    for i, bit in enumerate(_bits(F.col(key))):
        hit = hit & (F.col(f"{tag}w{i}").bitwiseAND(bit) != 0)
    rows = rows.withColumn(maybe, F.coalesce(F.col(said).isNull() & F.col(key).isNotNull() & hit, F.lit(False)))
    out = [*extra, "host", "path", "rule", said]
    sure = rows.where(~F.col(maybe)).select(*out, F.lit(False).alias(inside))
    hits = rows.where(maybe).join(listed, F.col(key) == F.col(known), "left")
    both = sure.unionByName(hits.select(*out, F.col(known).isNotNull().alias(inside)))
    method = F.when(F.col(inside), "block").otherwise("allow")
    return both.withColumn("verdict", F.coalesce(said, method)).drop(said, inside)


def junk_urls(pages):
    """The list of the registered query: canonical URLs of all pages on hosts with a junk label."""
    return pages.where(host_of(F.col("url")).rlike(JUNK)).select(canonical(F.col("url")).alias("url"))


def url_query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, junk_urls(pages)).select("page_id", "host", "path", "rule", "verdict")


_SQL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
URL_SQL = f"""
WITH u AS (
  SELECT page_id, url, translate(coalesce(regexp_extract(url, '{_SQL_PARTS}', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
    coalesce(regexp_extract(url, '{_SQL_PARTS}', 2), '') AS path,
    list_sort(list_filter(string_split(coalesce(regexp_extract(url, '{_SQL_PARTS}', 3), ''), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '{TRACKING}'))) AS query FROM pages),
k AS (
  SELECT *, CASE WHEN contains(url, '://') THEN host || rtrim(path, '/') ||
    CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END END AS key FROM u),
l AS (SELECT DISTINCT key FROM k WHERE regexp_matches(host, '{JUNK}')),
r(h, p, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
b AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM k JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT k.page_id, host, path, rule,
  coalesce(v, CASE WHEN l.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM k LEFT JOIN b USING (page_id) LEFT JOIN l ON l.key = k.key
"""
