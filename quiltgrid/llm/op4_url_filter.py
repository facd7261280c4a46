"""URL filter: list rules first, then empirical-Bayes host reputation.

Outcomes are the rows of ``labels`` whose id is a page's id; quality 1 is a good
page. The good rate of a host is shrunk towards its registered domain's, that
towards its suffix's, and that towards the rate of all labelled pages. Each
level's prior strength is the beta-binomial moment estimate from its own counts.
A page is allowed if the lower posterior bound of its host's good rate reaches
``min_good``; hosts without outcomes have their domain's prior.

Defined cases: a null url, or one without ``://``, has an empty host and path,
which form one host like any other; null qualities are no outcome; several
outcomes of one page all count; repeated pages each get a row; extra columns of
``pages`` are ignored. Without any outcome every good rate is 0.5, strength
``WEAKEST``, so that nothing is known and the bound fails only if it is below
``min_good``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltgrid.llm.common import ascii_lower, materialize, table

#: (verdict, rule): a rule is a host suffix followed by a path prefix.
RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)
#: Second-level names under two-letter suffixes that belong to the suffix.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
#: Prior strengths, in outcomes, are held between these.
WEAKEST, STRONGEST = 2.0, 1000.0
#: Standard deviations below the posterior mean, and the good rate asked for.
Z, MIN_GOOD = 1.645, 0.5


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    last = F.substring_index(host, ".", -1)
    second = F.element_at(F.split(F.substring_index(host, ".", -2), r"\."), 1)
    wide = (F.length(last) == 2) & second.isin(*SECOND_LEVEL) & host.contains(".")
    return F.when(wide, F.substring_index(host, ".", -2)).otherwise(last)


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and one name more."""
    return F.when(suffix.contains("."), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def rule_match(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _strength(groups: DataFrame) -> DataFrame:
    """One row: the beta-binomial moment estimate of the prior strength of ``groups`` (n, good, parent)."""
    spread = F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("parent"), 2) / F.greatest(F.col("parent") * (1 - F.col("parent")), F.lit(1e-6)))
    sums = groups.agg(F.count("*").alias("g"), F.sum("n").alias("t"), F.sum(F.col("n") * F.col("n")).alias("t2"), spread.alias("s"))
    rho = F.try_divide(F.col("s") - (F.col("g") - 1), F.col("t") - F.col("t2") / F.col("t") - (F.col("g") - 1))
    return sums.select(F.coalesce(F.when(rho > 0, F.greatest(F.lit(WEAKEST), F.least(F.lit(STRONGEST), 1 / rho - 1))).otherwise(F.lit(STRONGEST)), F.lit(WEAKEST)).alias("k"))


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, n, good, alpha, beta) for every host of ``pages`` (page_id, host).

    ``outcomes``: (page_id, good) with good 0 or 1. A page counts once for each host and
    different outcome that it has, however often its rows are repeated.
    """
    known = pages.where("page_id is not null").select("page_id", "host").distinct().join(outcomes.where("good is not null").select("page_id", "good").distinct(), "page_id")
    seen = known.select("host", "good").unionByName(pages.select("host", F.lit(None).cast(outcomes.schema["good"].dataType).alias("good")))
    suffix = suffix_of(F.col("host"))
    hosts = (
        seen.groupBy("host")
        .agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("good"))
        .withColumn("suffix", suffix)
        .withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    )
    hosts = materialize(hosts)  # a row per host: the three levels and their strengths read it, not the pages
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    rate = suffixes.agg(F.coalesce(F.try_divide(F.sum("good"), F.sum("n")), F.lit(0.5)).alias("parent"))

    def shrunk(level: DataFrame) -> DataFrame:
        """Each level's rows get alpha, beta and mean from their parent's mean; the one-row sides are broadcast."""
        k = _strength(level.where("n > 0"))
        return (
            level.join(F.broadcast(k))
            .withColumn("alpha", F.col("good") + F.col("k") * F.col("parent"))
            .withColumn("beta", F.col("n") - F.col("good") + F.col("k") * (1 - F.col("parent")))
            .withColumn("mean", F.col("alpha") / (F.col("alpha") + F.col("beta")))
        )

    suffixes = shrunk(suffixes.join(F.broadcast(rate)))
    domains = shrunk(domains.join(suffixes.select("suffix", F.col("mean").alias("parent")), "suffix"))
    hosts = shrunk(hosts.join(domains.select("domain", F.col("mean").alias("parent")), "domain"))
    return hosts.select("host", "n", "good", "alpha", "beta")


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, z: float = Z, min_good: float = MIN_GOOD) -> DataFrame:
    """(page_id, host, path, rule, verdict, labelled, good_rate, bound) for every row of ``pages`` (page_id, url)."""
    own = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    total = F.col("alpha") + F.col("beta")
    mean = F.col("alpha") / total
    known = host_reputation(own, outcomes).select(
        "host", F.col("n").alias("labelled"), mean.alias("good_rate"),
        (mean - z * F.sqrt(mean * (1 - mean) / (total + 1))).alias("bound"),
    )
    rule, verdict = rule_match(F.col("host"), F.col("path"), rules)
    found = F.when(F.col("bound") >= min_good, "allow").otherwise("block")
    return own.join(known, "host", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, found).alias("verdict"), "labelled", "good_rate", "bound")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return filter_urls(table(spark, sf_dir, "pages"), outcomes).select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL = """
with u as (
  select page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
h0 as (
  select host, count(quality) as n, coalesce(sum(quality), 0)::double as good
  from u left join (select doc_id, quality from labels where quality is not null) l on u.page_id = l.doc_id group by host),
h1 as (
  select *, string_split(host, '.') as parts,
    (len(parts) > 1 and strlen(parts[-1]) = 2 and parts[-2] in ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org')) as wide,
    array_to_string(parts[(case when wide then -2 else -1 end):], '.') as suffix,
    array_to_string(parts[(case when wide then -3 else -2 end):], '.') as domain
  from h0),
d0 as (select domain, suffix, sum(n) as n, sum(good) as good from h1 group by all),
s0 as (select suffix, sum(n) as n, sum(good) as good from d0 group by all),
r as (select coalesce(sum(good) / nullif(sum(n), 0), 0.5) as parent from s0),
s1 as (select s0.*, parent from s0, r),
ks as (select count(*) as g, sum(n) as t, sum(n * n) as t2, sum(n * pow(good / n - parent, 2) / greatest(parent * (1 - parent), 1e-6)) as s from s1 where n > 0),
ks1 as (select coalesce(case when (s - (g - 1)) / nullif(t - t2 / t - (g - 1), 0) > 0 then greatest(2.0, least(1000.0, 1 / ((s - (g - 1)) / nullif(t - t2 / t - (g - 1), 0)) - 1)) else 1000.0 end, 2.0) as k from ks),
s2 as (select suffix, (good + k * parent) / (n + k) as mean from s1, ks1),
d1 as (select d0.*, mean as parent from d0 join s2 using (suffix)),
kd as (select count(*) as g, sum(n) as t, sum(n * n) as t2, sum(n * pow(good / n - parent, 2) / greatest(parent * (1 - parent), 1e-6)) as s from d1 where n > 0),
kd1 as (select coalesce(case when (s - (g - 1)) / nullif(t - t2 / t - (g - 1), 0) > 0 then greatest(2.0, least(1000.0, 1 / ((s - (g - 1)) / nullif(t - t2 / t - (g - 1), 0)) - 1)) else 1000.0 end, 2.0) as k from kd),
d2 as (select domain, (good + k * parent) / (n + k) as mean from d1, kd1),
h2 as (select h1.*, mean as parent from h1 join d2 using (domain)),
kh as (select count(*) as g, sum(n) as t, sum(n * n) as t2, sum(n * pow(good / n - parent, 2) / greatest(parent * (1 - parent), 1e-6)) as s from h2 where n > 0),
kh1 as (select coalesce(case when (s - (g - 1)) / nullif(t - t2 / t - (g - 1), 0) > 0 then greatest(2.0, least(1000.0, 1 / ((s - (g - 1)) / nullif(t - t2 / t - (g - 1), 0)) - 1)) else 1000.0 end, 2.0) as k from kh),
h3 as (select host, good + k * parent as a, n - good + k * (1 - parent) as b from h2, kh1),
h4 as (select host, a / (a + b) - 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) as bound from h3),
rules(verdict, rule, name, start) as (values
  ('block', 'com/en/', 'com', '/en/'), ('allow', 'example.com/en/7', 'example.com', '/en/7'), ('allow', 'net/de/', 'net', '/de/'),
  ('block', 'example.net/de/8', 'example.net', '/de/8'), ('block', 'org/es/', 'org', '/es/')),
hp as (select distinct host, path from u),
best as (
  select host, path, max_by(rule, strlen(rule)) as rule, max_by(verdict, strlen(rule)) as verdict
  from hp join rules on (host = name or ends_with(host, '.' || name)) and starts_with(path, start) group by host, path)
select u.page_id, u.host, u.path, best.rule, coalesce(best.verdict, case when bound >= 0.5 then 'allow' else 'block' end) as verdict
from u join h4 on u.host = h4.host left join best on u.host = best.host and u.path = best.path
"""
