"""URL filters: fixed rules first, then an empirical-Bayes reputation of hosts.

Labelled outcomes of pages are counted per host, registered domain and suffix. Each level is a
beta-binomial whose prior is the posterior of the level above, without the node's own outcomes; the strength of a level's
prior is fitted to the spread between its groups by the method of moments. A host is blocked where even the upper posterior bound
of its share of good pages is below a floor.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ementario.llm.columns import ascii_lower
from ementario.session import materialize

# Usual labels below a country's own, under which domains are registered.
GENERIC = ("ac", "co", "com", "edu", "go", "gob", "gov", "mil", "ne", "net", "or", "org")
#: Names that must stand under two labels for these to count as a suffix.
MANY_NAMES = 100


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or where ``://`` is missing."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.char_length(host) + 1, F.length(rest))
    path = F.regexp_extract(after, r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule whose host is the page's or above it and whose path starts the page's."""
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        here = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        fits = F.when(here, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(fits)
    return fits


def bare_host(host: Column) -> Column:
    """The host without its port."""
    return F.regexp_replace(host, r":\d*$", "")


def is_address(bare: Column) -> Column:
    return F.regexp_like(bare, F.lit(r"^\d+\.\d+\.\d+\.\d+$")) | bare.startswith("[")


def registered_domains(hosts: DataFrame, many: int = MANY_NAMES) -> DataFrame:
    """``hosts`` (distinct ones) with ``domain`` and ``suffix``.

    A suffix is the last label, or the last two where the first of them is a usual one below a country (``GENERIC``) or where at
    least ``many`` different names stand under the two in this table: nothing says then that these names have one owner. An
    address is its own domain and suffix.
    """
    bare = bare_host(F.col("host"))
    two, three = F.substring_index(bare, ".", -2), F.substring_index(bare, ".", -3)
    rows = hosts.withColumns({"bare": bare, "two": two, "three": three, "address": is_address(bare)})
    shared = rows.where("NOT address AND three <> two").groupBy("two").agg(F.countDistinct("three").alias("names"))
    shared = shared.where(F.col("names") >= many).select(F.col("two").alias("shared"))
    rows = rows.join(shared, F.col("two") == F.col("shared"), "left")
    country = F.regexp_like("two", F.lit(r"^(" + "|".join(GENERIC) + r")\.[a-z]{2}$"))
    deep = F.col("shared").isNotNull() | country
    domain = F.when(F.col("address"), F.col("bare")).when(deep, F.col("three")).otherwise(F.col("two"))
    suffix = F.when(F.col("address"), F.col("bare")).when(deep, F.col("two")).otherwise(F.substring_index("bare", ".", -1))
    return rows.select(*hosts.columns, domain.alias("domain"), suffix.alias("suffix"))


def outcomes(labels: DataFrame) -> DataFrame:
    """One row per labelled page: bad if any of its labels says low quality or toxic."""
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    return labels.groupBy(F.col("doc_id").alias("page_id")).agg((1 - F.max(bad.cast("int"))).alias("good"))


def _strength(counts: DataFrame, lowest: float = 1.0, highest: float = 1000.0) -> float:
    """The strength of a prior that fits the spread of the outcomes between the groups of a level.

    One row of sums reaches the driver. Where the spread is no larger than chance the prior is as strong as allowed.
    """
    n, x = F.col("n").cast("double"), F.col("good").cast("double")
    row = counts.where("n > 0").agg(
        F.count("*").alias("k"), F.sum(n).alias("n"), F.sum(x).alias("x"),
        F.sum(n * n).alias("nn"), F.sum(x * x / n).alias("xx"),
    ).first()
    if not row.n:
        return lowest
    mean = row.x / row.n
    within = mean * (1 - mean)
    chance = row.n - row.nn / row.n - (row.k - 1)
    if within <= 0 or chance <= 0:
        return highest
    rho = (row.xx - row.n * mean * mean - within * (row.k - 1)) / (within * chance)
    return highest if rho <= 0 else min(highest, max(lowest, (1 - rho) / rho))


def _evidence(counts: DataFrame, k: float, name: str) -> DataFrame:
    """``counts`` and what each group says about the level above: its outcomes, many of which weigh no more than ``k`` + 1.

    Groups differ from each other as a prior of strength ``k`` has it, so a thousand pages of one domain tell of the suffix
    hardly more than its mean does.
    """
    n = F.col("n") * (k + 1) / (F.col("n") + k)
    share = F.when(F.col("n") > 0, F.col("good") / F.col("n")).otherwise(0.0)
    return counts.withColumn(f"{name}_n", n).withColumn(f"{name}_good", F.col(f"{name}_n") * share)


def host_reputation(pages: DataFrame, labels: DataFrame, z: float = 1.645) -> DataFrame:
    """One row per host: n, good, mean and the posterior bounds (lower, upper) of its share of good pages.

    ``pages`` has page_id and host. A host's prior is what the other hosts of its domain show, shrunk towards what the other
    domains of the suffix show, and that towards all other suffixes: a node's own outcomes are never part of its prior. Each
    level has its own strength. Counts are aggregated map-side, so a host with a third of all pages is one row per task.
    """
    labelled = pages.join(outcomes(labels), "page_id", "left")
    by_host = labelled.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    by_host = materialize(registered_domains(materialize(by_host, "host-outcomes")), "host-counts")
    k_host = _strength(by_host)
    hosts = _evidence(by_host, k_host, "host")
    # Suffixes are few but may hold most hosts: their sums are made per task first, then joined.
    by_domain = materialize(hosts.groupBy("domain", "suffix").agg(F.sum("host_n").alias("n"), F.sum("host_good").alias("good")), "domain-counts")
    k_domain = _strength(by_domain)
    domains = _evidence(by_domain, k_domain, "domain")
    by_suffix = materialize(domains.groupBy("suffix").agg(F.sum("domain_n").alias("n"), F.sum("domain_good").alias("good")), "suffix-counts")
    k_suffix = _strength(by_suffix)
    suffixes = _evidence(by_suffix, k_suffix, "suffix")
    total = suffixes.agg(F.coalesce(F.sum("suffix_n"), F.lit(0.0)).alias("n"), F.coalesce(F.sum("suffix_good"), F.lit(0.0)).alias("good")).first()

    def others(parent: tuple[Column, Column], child: str, k: float, prior: Column) -> Column:
        """What a parent's other children show, shrunk towards the parent's own prior."""
        return (parent[1] - F.col(f"{child}_good") + k * prior) / (parent[0] - F.col(f"{child}_n") + k)

    rest = others((F.lit(total.n), F.lit(total.good)), "suffix", 1.0, F.lit(0.5))
    up = domains.withColumnsRenamed({"n": "d_n", "good": "d_good"}).join(suffixes, "suffix")
    up = up.withColumn("p", others((F.col("n"), F.col("good")), "domain", k_suffix, rest))
    up = materialize(up.select("domain", "suffix", "d_n", "d_good", "p"), "domain-priors")
    prior = others((F.col("d_n"), F.col("d_good")), "host", k_domain, F.col("p"))
    known = F.col("d_n") - F.col("host_n") + k_domain
    hosts = hosts.join(up, ["domain", "suffix"]).select("host", "n", "good", prior.alias("prior"), known.alias("known"))
    a = F.col("good") + k_host * F.col("prior")
    b = F.col("n") - F.col("good") + k_host * (1 - F.col("prior"))
    # The prior itself is known from so much evidence only, which matters as far as it weighs.
    weight = k_host / (F.col("n") + k_host)
    unsure = weight * weight * F.col("prior") * (1 - F.col("prior")) / (F.col("known") + 1)
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)) + unsure)
    return hosts.withColumn("mean", a / (a + b)).select(
        "host", "n", "good", "mean",
        F.greatest(F.lit(0.0), F.col("mean") - z * sd).alias("lower"),
        F.least(F.lit(1.0), F.col("mean") + z * sd).alias("upper"),
    )


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, floor: float = 0.5, z: float = 1.645
) -> DataFrame:
    """page_id, host, path, rule, verdict, mean, lower and upper of every page.

    The verdict is the longest fitting rule's, else ``block`` where the host's upper bound is below ``floor`` and
    ``allow`` otherwise. Null urls and those without ``://`` have an empty host and path; the empty host is judged
    like any other. Every row is judged, repeated ones too; a null page_id has no outcome. Only page_id and url
    are read, so extra columns cannot clash.
    """
    host, path = url_parts(F.col("url"))
    parsed = materialize(pages.select("page_id", host.alias("host"), path.alias("path")), "page-hosts")
    # Written before the join, so that both of its sides are plain exchanges and a hot host can be split.
    known = materialize(host_reputation(parsed.select("page_id", "host"), labels, z), "host-reputation")
    hit = matched_rule(F.col("host"), F.col("path"), rules)
    judged = parsed.join(known.drop("n", "good"), "host", "left").withColumn("hit", hit)
    model = F.when(F.col("upper") < floor, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.verdict"), model).alias("verdict"), "mean", "lower", "upper",
    )
