"""URL filters (operator 3): list rules, then empirical-Bayes reputation of hosts.

Labelled page outcomes (bad or not) are counted per host, registered domain and suffix. At each
level a beta-binomial prior is centred on the parent's posterior mean, and its weight is fitted from
the spread of the level's groups by moments: groups that differ little from their parents are shrunk
strongly. A host is bad if the lower bound of its posterior bad rate lies above ``most_bad``; hosts
without labels have their domain's or suffix's posterior.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygrid.llm.common import BROADCAST_ROWS, lower_ascii, written

#: Suffixes of several labels under which sites of different owners are registered: common ones, not the
#: whole public list, which callers pass as ``suffixes``.
SUFFIXES = tuple(
    "ac.uk co.uk gov.uk ltd.uk me.uk net.uk nhs.uk org.uk plc.uk sch.uk com.au edu.au gov.au id.au net.au org.au ac.nz co.nz govt.nz net.nz org.nz "
    "ac.jp co.jp go.jp ne.jp or.jp ac.kr co.kr go.kr or.kr com.cn edu.cn gov.cn net.cn org.cn com.hk com.tw com.sg com.my com.ph com.vn co.id go.id "
    "or.id ac.id co.th or.th ac.in co.in gov.in net.in org.in com.br gov.br net.br org.br com.ar com.mx com.co com.pe com.tr com.ua com.pl co.il "
    "co.za org.za com.eg com.ng co.ke com.sa github.io gitlab.io blogspot.com wordpress.com herokuapp.com netlify.app vercel.app pages.dev web.app".split()
)

URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    action: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null url or one without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, URL_PATTERN, 1)), F.regexp_extract(url, URL_PATTERN, 2)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, action) of the longest rule that fits, else null; of equal ones a block wins.

    The list becomes one expression: it is configuration, not data.
    """
    fitting = [
        F.when(
            ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
            F.struct(F.lit(len(r.text)).alias("length"), F.lit(int(r.action == "block")).alias("block"), F.lit(r.text).alias("rule"), F.lit(r.action).alias("action")),
        )
        for r in rules
    ]
    if not fitting:
        return F.lit(None).cast("struct<length:int,block:int,rule:string,action:string>")
    return F.array_max(F.array(*fitting))


def _labels(host: Column, suffixes: Sequence[str], more: int) -> Column:
    """The last labels of a host, ``more`` than the longest of ``suffixes`` it ends with has, or than one."""
    by_size: dict[int, list[str]] = {}
    for s in suffixes:
        by_size.setdefault(s.count(".") + 1, []).append(s)
    out = F.substring_index(host, ".", -1 - more)
    for n in sorted(by_size):
        out = F.when(F.substring_index(host, ".", -n).isin(by_size[n]), F.substring_index(host, ".", -n - more)).otherwise(out)
    return out


def domain_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The registered domain of a host: its suffix and one label."""
    return _labels(host, suffixes, 1)


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The longest of ``suffixes`` that a host ends with, else its last label."""
    return _labels(host, suffixes, 0)


def _level(groups: DataFrame, key: str, mean: Column, most_weight: float = 1e4) -> DataFrame:
    """Posterior (alpha, beta) of the groups of a level: counts n, bad; ``mean`` is the parent's.

    Moments: the groups' squared deviations from their parents' means exceed binomial noise by
    m(1-m)/(weight+1) of what they would be for one-point groups.
    """
    noise = mean * (1 - mean)
    g = groups.withColumn("mean", mean).withColumn("noise", noise)
    fit = g.filter("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("mean"), 2)).alias("spread"), F.sum("noise").alias("noise1"), F.sum((F.col("n") - 1) * F.col("noise")).alias("noise2")
    )
    # E[spread] = noise1 + noise2 * rho with rho = 1 / (weight + 1)
    rho = F.greatest(F.lit(1 / most_weight), F.least(F.lit(0.5), F.coalesce((F.col("spread") - F.col("noise1")) / F.nullif(F.col("noise2"), F.lit(0.0)), F.lit(1 / most_weight))))
    return (
        g.withColumn("weight", fit.select((1 / rho - 1).alias("weight")).scalar())
        .withColumn("alpha", F.col("weight") * F.col("mean") + F.col("bad"))
        .withColumn("beta", F.col("weight") * (1 - F.col("mean")) + F.col("n") - F.col("bad"))
        .select(*groups.columns, "alpha", "beta", (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias(f"{key}_mean"))
    )


def reputations(hosts: DataFrame, z: float = 1.645, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """host, alpha, beta, bad_mean, bad_low (lower posterior bound) from rows (host, n, bad), one per host.

    The bound is the beta posterior's normal one, mean - z sd. Without any label every host has the
    flat prior's mean.
    """
    named = hosts.withColumn("domain", domain_of(F.col("host"), suffixes)).withColumn("suffix", suffix_of(F.col("host"), suffixes))
    named = written(named, "hosts")  # each level reads its groups twice
    total = named.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1.0) / (F.coalesce(F.sum("n"), F.lit(0)) + 2.0)).alias("all_mean"))
    suffixes = named.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("all_mean", total.scalar())
    suffixes = _level(written(suffixes, "suffixes"), "suffix", F.col("all_mean")).select("suffix", "suffix_mean")
    domains = named.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).join(suffixes, "suffix")
    domains = _level(written(domains, "domains"), "domain", F.col("suffix_mean")).select("domain", "domain_mean")
    out = _level(named.join(domains, "domain"), "host", F.col("domain_mean"))
    both = F.col("alpha") + F.col("beta")
    sd = F.sqrt(F.col("alpha") * F.col("beta") / (both * both * (both + 1)))
    return out.select("host", "n", "bad", "alpha", "beta", F.col("host_mean").alias("bad_mean"), F.greatest(F.lit(0.0), F.col("host_mean") - z * sd).alias("bad_low"))


def outcomes_by_host(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, n, bad) for every host of ``pages`` (page_id, host); ``outcomes`` has page_id, bad (0 or 1).

    A page counts once per host, however often its row or its outcome is repeated; of different outcomes
    the bad one holds. Null ids and outcomes tell nothing.

    Hosts are counted before and after the join on page ids, so that a host with a third of all pages
    meets as partial counts.
    """
    seen = pages.groupBy("host").agg(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad"))
    known = outcomes.filter("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    labelled = pages.filter("page_id IS NOT NULL").select("host", "page_id").distinct().join(known, "page_id").groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
    return seen.unionByName(labelled).groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], most_bad: float = 0.5, z: float = 1.645, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url).

    Null urls and urls without ``://`` have an empty host and path and are judged as that host.
    Repeated rows stay, and count once as outcomes; an empty table gives none; other columns are not read.
    """
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
    known = reputations(outcomes_by_host(rows.select("page_id", "host"), outcomes), z, suffixes)
    worst = known.filter(F.col("bad_low") > most_bad).select("host", F.lit(True).alias("bad_host"), "bad_mean")
    worst = written(worst, "bad-hosts")
    # Only bad hosts are looked up. Too many to broadcast, they meet the pages in a sort-merge join,
    # whose large partitions adaptive execution splits.
    worst = F.broadcast(worst) if worst.count() <= BROADCAST_ROWS else worst.hint("merge")
    verdict = F.coalesce(F.col("fit.action"), F.when(F.col("bad_host"), "block").otherwise("allow"))
    return rows.join(worst, "host", "left").select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"))
