"""Reputation of web hosts by empirical Bayes, and the filter that follows from it.

Labelled pages, or pages as the rules leave them, are counted per host, then per registered domain and public suffix; only counts are
shuffled. Going down from all pages to suffix, domain and host, each level is a beta distribution whose
mean is the posterior mean of the level above and whose strength is fitted from how much the children
differ (moments of a beta-binomial). A host with many labelled pages is judged by them, one with few by
its relatives. Hosts are blocked whose bad share is surely too high: the lower bound, mean less a
multiple of the deviation, counts, so a host without evidence is not blocked for its relatives alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourtide.llm.common import LOWER, UPPER, sql_list, stage

# The rules of the registered query, in the order given.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Public suffixes of more than one label; a parameter, to be replaced by a full list.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br")
#: Prior bad share where nothing is labelled at all, as pseudo-counts.
BASE_BAD, BASE_N = 1.0, 2.0
#: Strength (pseudo-counts) of a level whose children do not differ, and of one without labels.
MOST_STRENGTH, LEAST_STRENGTH = 1000.0, 0.5
Z = 1.645
MOST_BAD = 0.5


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host to the next ``?`` or ``#``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict. A rule fits its host, all subdomains, and every path
    that starts with its own. The rules are a short list, tried longest first."""
    name = verdict = None
    for action, of, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        name = F.when(fits, of + start) if name is None else name.when(fits, of + start)
        verdict = F.when(fits, action) if verdict is None else verdict.when(fits, action)
    nothing = F.lit(None).cast("string")
    return (nothing, nothing) if name is None else (name, verdict)


def suffix_of(host: Column, long_suffixes=LONG_SUFFIXES) -> Column:
    last, two = F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)
    return F.when(two.isin(*long_suffixes), two).otherwise(last) if long_suffixes else last


def domain_of(host: Column, long_suffixes=LONG_SUFFIXES) -> Column:
    two, three = F.substring_index(host, ".", -2), F.substring_index(host, ".", -3)
    return F.when(two.isin(*long_suffixes), three).otherwise(two) if long_suffixes else two


def _strength(children: DataFrame, level: str) -> DataFrame:
    """(level, strength) from (level, bad, n, mean): the squared distances of the children's shares from
    the parent's mean exceed those of the binomial law by rho = 1 / (strength + 1)."""
    share = F.col("bad") / F.col("n")
    each = children.where(F.col("n") > 1).select(
        level, (F.col("n") * F.pow(share - F.col("mean"), 2)).alias("seen"), (F.col("mean") * (1 - F.col("mean"))).alias("expected"), "n"
    )
    sums = each.groupBy(level).agg(
        F.sum("seen").alias("seen"), F.sum("expected").alias("expected"), F.sum(F.col("expected") * (F.col("n") - 1)).alias("extra")
    )
    rho = F.try_divide(F.col("seen") - F.col("expected"), F.col("extra"))
    strength = F.greatest(F.least(1 / F.greatest(rho, F.lit(1e-9)) - 1, F.lit(MOST_STRENGTH)), F.lit(LEAST_STRENGTH))
    return sums.select(level, strength.alias("strength"))


def reputations(outcomes: DataFrame, long_suffixes=LONG_SUFFIXES) -> DataFrame:
    """(host, domain, suffix, bad, n, mean, bound) per host of ``outcomes`` (host, bad), where ``bad`` is
    1, 0 or null for a page without a label. A level without varying children keeps its default strength."""
    hosts = (
        outcomes.groupBy("host")
        .agg(F.sum(F.col("bad").cast("bigint")).alias("bad"), F.count("bad").alias("n"))
        .select("host", domain_of(F.col("host"), long_suffixes).alias("domain"), suffix_of(F.col("host"), long_suffixes).alias("suffix"),
                F.coalesce("bad", F.lit(0)).alias("bad"), "n")
    )
    hosts = stage(hosts, "hosts")
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    suffixes = domains.groupBy("suffix").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    whole = suffixes.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    root = whole.select(((F.coalesce("bad", F.lit(0)) + BASE_BAD) / (F.coalesce("n", F.lit(0)) + BASE_N)).alias("mean"))

    def shrunk(children: DataFrame, level: str | None) -> DataFrame:
        """``children`` carry the parent's ``mean``; theirs replaces it, and ``spread`` is the deviation."""
        by = F.lit("") if level is None else F.col(level)
        keyed = children.withColumn("level_", by)
        joined = keyed.join(_strength(keyed, "level_"), "level_", "left")
        strength = F.coalesce("strength", F.lit(LEAST_STRENGTH * 4))
        weight = F.col("n") + strength
        mean = (F.col("bad") + strength * F.col("mean")) / weight
        kept = [c for c in children.columns if c != "mean"]
        return joined.select(*kept, mean.alias("mean"), F.sqrt(mean * (1 - mean) / (weight + 1)).alias("spread"))

    top = shrunk(suffixes.withColumn("mean", root.scalar()), None)
    middle = shrunk(domains.join(top.select("suffix", "mean"), "suffix"), "suffix")
    low = shrunk(hosts.join(middle.select("domain", "mean"), "domain"), "domain")
    return low.select("host", "domain", "suffix", "bad", "n", "mean", (F.col("mean") - Z * F.col("spread")).alias("bound"))


def judge(
    df: DataFrame, id: str = "page_id", url: str = "url", label: str | None = None, rules=RULES, most_bad: float = MOST_BAD,
    long_suffixes=LONG_SUFFIXES,
) -> DataFrame:
    """One row per row of ``df``: page_id, host, path, rule, verdict, bad_share, bound.

    ``label`` names a column with 1 for a bad page, 0 for a good one and null for an unlabelled one; without
    it a page that a rule blocks is bad and every other one good: what nobody has blocked speaks for its host. The longest fitting rule decides, else the
    host's bound: above ``most_bad`` it is blocked. A null url, or one without ``://``, has an empty host
    and path, and is judged as pages of the empty host. Repeated rows are judged alike. An empty table
    gives no rows. The staged hosts are written when this is called.
    """
    link = df[f"`{url}`"]
    parts = df.select(
        df[f"`{id}`"].alias("page_id"),
        host_of(link).alias("host"),
        path_of(link).alias("path"),
        *([df[f"`{label}`"].cast("int").alias("bad")] if label else []),
    )
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = parts.select("*", rule.alias("rule"), verdict.alias("ruling"))
    outcome = F.col("bad") if label else F.coalesce((F.col("ruling") == "block").cast("int"), F.lit(0))
    hosts = stage(reputations(ruled.select("host", outcome.alias("bad")), long_suffixes), "reputations")
    fallback = F.when(F.col("bound") > most_bad, "block").otherwise("allow")
    return ruled.join(hosts.select("host", F.col("mean").alias("bad_share"), "bound"), "host").select(
        "page_id", "host", "path", "rule", F.coalesce("ruling", fallback).alias("verdict"), F.round("bad_share", 6).alias("bad_share"),
        F.round("bound", 6).alias("bound"),
    )


def _sql() -> str:
    long = sql_list(list(LONG_SUFFIXES))
    fits = [
        (f"(host = '{of}' or suffix(host, '.{of}')) and starts_with(path, '{start}')", of + start, action)
        for action, of, start in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r))
    ]
    cases = lambda i: "case " + " ".join(f"when {f[0]} then '{f[i]}'" for f in fits) + " end"

    def level(name: str, children: str, key: str, kept: str) -> str:
        return f"""{name}_strength as (
          select {key} as k, greatest(least(1 / greatest((sum(n * pow(bad / n - mean, 2)) - sum(mean * (1 - mean)))
            / nullif(sum(mean * (1 - mean) * (n - 1)), 0), 1e-9) - 1, {MOST_STRENGTH}), {LEAST_STRENGTH}) as strength
          from {children} where n > 1 group by 1
        ), {name}_weighed as (
          select c.*, coalesce(strength, {LEAST_STRENGTH * 4}) as s from {children} c left join {name}_strength on {key} = k
        ), {name} as (
          select {kept}, (bad + s * mean) / (n + s) as mean, n + s as weight from {name}_weighed
        )"""

    return f"""
with parts as (
  select page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') as host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path from pages
), ruled as (
  select *, {cases(1)} as rule, {cases(2)} as ruling from parts
), names as (
  select host, sum(case ruling when 'block' then 1.0 else 0.0 end) as bad, cast(count(*) as double) as n,
    array_to_string(string_split(host, '.')[-1:], '.') as last1, array_to_string(string_split(host, '.')[-2:], '.') as last2,
    array_to_string(string_split(host, '.')[-3:], '.') as last3
  from ruled group by host
), hosts as (
  select host, bad, n, case when last2 in ({long}) then last3 else last2 end as domain,
    case when last2 in ({long}) then last2 else last1 end as suffix from names
), domains as (select suffix, domain, sum(bad) as bad, sum(n) as n from hosts group by suffix, domain
), suffixes as (select suffix, sum(bad) as bad, sum(n) as n from domains group by suffix
), suffixes_in as (
  select *, (select (coalesce(sum(bad), 0) + {BASE_BAD}) / (coalesce(sum(n), 0) + {BASE_N}) from suffixes) as mean from suffixes
), {level("top", "suffixes_in", "''", "suffix")}
, domains_in as (select d.*, top.mean from domains d join top on d.suffix = top.suffix
), {level("middle", "domains_in", "suffix", "domain")}
, hosts_in as (select h.*, middle.mean from hosts h join middle on h.domain = middle.domain
), {level("low", "hosts_in", "domain", "host")}
, bounds as (select host, mean, mean - {Z} * sqrt(mean * (1 - mean) / (weight + 1)) as bound from low)
select page_id, r.host, path, rule, coalesce(ruling, case when bound > {MOST_BAD} then 'block' else 'allow' end) as verdict,
  round(mean, 6) as bad_share, round(bound, 6) as bound
from ruled r join bounds b on r.host = b.host
"""


SQL = _sql()
