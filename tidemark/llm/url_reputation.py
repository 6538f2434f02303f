"""Verdicts on urls: rules first, then the shrunken reputation of the host.

Outcomes of labelled pages are counted per host, registered domain and suffix. At each level a
beta prior, whose mean is the posterior mean of the level above and whose strength is estimated
from the spread of the rates by the method of moments, is updated with the counts. A host with
few labels so falls back to its domain, and that to its suffix. A url is allowed when the lower
posterior bound of its host's share of good pages reaches ``min_good``.

Only DataFrame functions are used. Per-host counts are combined before the shuffle and written
once for all levels; the join back to the pages is on hosts, where Spark splits a hot host.

Defined cases: a null url or one without ``://`` has empty host and path, takes part in the
global prior only through its (empty) host, and gets a verdict like any other host. A null
outcome is no outcome. Repeated pages are judged each; an empty table gives no rows; with no
outcome at all every posterior is the uniform prior. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import durable

LEVELS = ("suffix", "domain", "host")
Z = 1.645
MIN_GOOD = 0.5
MIN_STRENGTH, MAX_STRENGTH = 2.0, 1000.0
# Labels that stand below a country code without naming a registrant (fixed values).
SECOND_LEVEL = ["ac", "co", "com", "edu", "gov", "net", "org"]


def url_parts(url: str) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url column; both empty if it has no ``://``."""
    known = F.instr(F.col(url), "://") > 0
    rest = F.expr(f"substring({url}, instr({url}, '://') + 3)")
    host = F.translate(
        F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path and the levels above the host."""
    host, path = url_parts("url")
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    labels = F.split(F.regexp_replace("host", ":[0-9]*$", ""), "\\.")
    n = F.size(labels)
    two = (n >= 3) & (F.length(F.element_at(labels, -1)) == 2) & F.get(labels, n - 2).isin(SECOND_LEVEL)
    deep = F.when(two, 2).otherwise(1)

    def last(k: Column) -> Column:
        return F.concat_ws(".", F.slice(labels, F.greatest(F.lit(1), n - k + 1), k))

    return parts.withColumn("suffix", last(deep)).withColumn("domain", last(deep + 1))


def rule_of(rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as (rule, action); rules are (action, host, path) parameters."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]))

    def fits(host: str, path: str) -> Column:
        return ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)

    cases = [(fits(h, p), F.struct(F.lit(h + p).alias("rule"), F.lit(a).alias("action"))) for a, h, p in ordered]
    return F.coalesce(*[F.when(c, v) for c, v in cases]) if cases else F.lit(None).cast("struct<rule:string,action:string>")


def _strength(counts: DataFrame, prior: Column) -> DataFrame:
    """How strongly rates cling to their prior means: one row, by the method of moments.

    Over groups with n outcomes and prior mean m, E[(k - n m)^2] = n m (1 - m) (1 + (n - 1) r)
    with r = 1 / (strength + 1).
    """
    spread = prior * (1 - prior)
    excess = F.sum((F.col("k") - F.col("n") * prior) * (F.col("k") - F.col("n") * prior) - F.col("n") * spread)
    r = F.try_divide(excess, F.sum(F.col("n") * (F.col("n") - 1) * spread))
    strength = F.when(r > 0, F.try_divide(F.lit(1.0), r) - 1).otherwise(MAX_STRENGTH)
    bounded = F.greatest(F.lit(MIN_STRENGTH), F.least(F.lit(MAX_STRENGTH), F.coalesce(strength, F.lit(MAX_STRENGTH))))
    return counts.agg(F.round(bounded, 6).alias("s"))


def host_reputation(parts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """host, bound: the lower posterior bound of the share of good pages of every host.

    ``outcomes`` has (page_id, good); the one-row priors are read by the driver.
    """
    known = outcomes.where("good IS NOT NULL").select("page_id", F.col("good").cast("long").alias("good"))
    hosts = durable(
        parts.join(known, "page_id", "left")
        .groupBy(*LEVELS)
        .agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"))
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    above = ((total.k or 0) + 1.0) / ((total.n or 0) + 2.0)
    posterior = None
    for depth, level in enumerate(LEVELS):
        keys = list(LEVELS[: depth + 1])
        counts = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        if posterior is None:
            counts = counts.withColumn("m", F.lit(above))
        else:
            counts = counts.join(posterior, keys[:-1])
        s = _strength(counts, F.col("m")).first().s
        a, b = F.col("m") * s + F.col("k"), (1 - F.col("m")) * s + F.col("n") - F.col("k")
        mean = a / (a + b)
        if level == "host":
            bound = mean - Z * F.sqrt(mean * (1 - mean) / (a + b + 1))
            return counts.select("host", F.round(bound, 6).alias("bound"))
        posterior = counts.select(*keys, F.round(mean, 9).alias("m"))
    return None


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]], min_good: float = MIN_GOOD
) -> DataFrame:
    """page_id, host, path, rule, verdict and the bound for every page."""
    parts = with_parts(pages)
    ruled = parts.withColumn("__r", rule_of(rules))
    return ruled.join(host_reputation(parts, outcomes), "host").select(
        "page_id", "host", "path", F.col("__r.rule").alias("rule"),
        F.coalesce("__r.action", F.when(F.col("bound") >= min_good, "allow").otherwise("block")).alias("verdict"),
        F.col("bound").alias("good_bound"),
    )


# The rules of the registered query: (action, host, path), fixed values.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def _sql() -> str:
    whens = "\n".join(
        f"    WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{a} {h}{p}'"
        for a, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0])))

    def level(name: str, keys: str, above: str) -> str:
        return f"""
{name}_c AS (SELECT {keys}, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY {keys}),
{name}_m AS (SELECT c.*, {above}),
{name}_r AS (SELECT sum((k - n * m) * (k - n * m) - n * m * (1 - m)) / sum(n * (n - 1) * m * (1 - m)) AS r
  FROM {name}_m),
{name}_s AS (SELECT round(greatest({MIN_STRENGTH}, least({MAX_STRENGTH},
  CASE WHEN r > 0 AND isfinite(r) THEN 1 / r - 1 ELSE {MAX_STRENGTH} END)), 6) AS s FROM {name}_r),
{name}_p AS (SELECT x.*, (m * s + k) / (m * s + k + (1 - m) * s + n - k) AS mean,
  m * s + k + (1 - m) * s + n - k AS w FROM {name}_m x, {name}_s)"""

    return f"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
l AS (SELECT *, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS parts FROM h),
d AS (SELECT *, CASE WHEN len(parts) >= 3 AND length(parts[-1]) = 2
  AND parts[-2] IN ({", ".join(f"'{x}'" for x in SECOND_LEVEL)}) THEN 2 ELSE 1 END AS deep FROM l),
p AS (SELECT page_id, host, path,
  array_to_string(parts[greatest(1, len(parts) - deep + 1):], '.') AS suffix,
  array_to_string(parts[greatest(1, len(parts) - deep):], '.') AS domain FROM d),
hosts AS (
  SELECT suffix, domain, host, count(quality) AS n, coalesce(sum(quality), 0) AS k
  FROM p LEFT JOIN labels ON doc_id = page_id GROUP BY ALL),
top AS (SELECT (sum(k) + 1.0::DOUBLE) / (sum(n) + 2.0::DOUBLE) AS m FROM hosts),
{level("suffix", "suffix", "m::DOUBLE AS m FROM suffix_c c, top")},
{level("domain", "suffix, domain", "round(q.mean, 9) AS m FROM domain_c c JOIN suffix_p q USING (suffix)")},
{level("host", "suffix, domain, host", "round(q.mean, 9) AS m FROM host_c c JOIN domain_p q USING (suffix, domain)")},
bounds AS (SELECT host, round(mean - {Z} * sqrt(mean * (1 - mean) / (w + 1)), 6) AS good_bound FROM host_p),
r AS (SELECT *, CASE
{whens}
  END AS hit FROM p)
SELECT page_id, r.host, path, split_part(hit, ' ', 2) AS rule,
  coalesce(split_part(hit, ' ', 1), CASE WHEN good_bound >= {MIN_GOOD} THEN 'allow' ELSE 'block' END) AS verdict,
  good_bound
FROM r JOIN bounds b ON r.host = b.host
"""


SQL = _sql()
