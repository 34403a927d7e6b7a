"""URL filters by link-graph propagation.

Rules (host, path) judge the urls they fit; the longest fitting rule wins. For every
other url the host's standing decides. Hosts with allowed pages are trusted seeds and
hosts with blocked pages distrusted seeds, by their numbers of such pages. Trust follows
the links between hosts (personalised PageRank from the trusted seeds); distrust follows
them backwards (a host that links to blocked ones is suspect). A host is blocked when

    (trust - distrust) / (trust + distrust) < BLOCK_BELOW

and allowed otherwise, also without any evidence; trust and distrust that sum to less than ``FAINTEST`` times the smallest
seed's share are none. Both are summed along paths of links, a step at a time, until what still moves is less than that: no
number of steps decides a verdict. The trust of a host without links
out isn't passed on, nor is the distrust of one without links in.

DataFrame functions only. Scale: pages are reduced to host edges and host seeds by
partial aggregates, then each step of the propagation is one join and one aggregate over host
edges, written to the shared folder every ``WRITE_EVERY`` steps. Pages are joined with
their host's standing by id columns only.

Defined results: a null url or one without :// has an empty host and path, fits no rule and
is allowed; null html has no links; repeated rows are judged alike and count as often; links
from a host to itself carry nothing; html of any length is searched in linear time, by Spark; an empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize, table


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))
DAMPING = 0.85
FAINTEST = 1e-6
WRITE_EVERY = 8
BLOCK_BELOW = -0.5
#: An absolute link of an anchor; group 1 is its host.
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _UPPER.lower())


def _rest(url: Column) -> Column:
    """What follows the first :// (null without one)."""
    return F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3))


def url_host(url: Column) -> Column:
    return F.coalesce(lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls. A rule list is a parameter of a few rows."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.host + r.path)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links from pages of one host to another."""
    links = pages.select(url_host(F.col("url")).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
    return links.withColumn("dst", lower(F.col("dst"))).filter("src <> dst and src <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def standings(edges: DataFrame, seeds: DataFrame, faintest: float = FAINTEST, damping: float = DAMPING) -> DataFrame:
    """(host, standing) from edges (src, dst, n) and seeds (host, kind, share):
    kind ``trust`` follows edges, ``distrust`` follows them backwards."""
    out = edges.groupBy("src").agg(F.sum("n").alias("all"))
    back = edges.groupBy("dst").agg(F.sum("n").alias("all"))
    ways = edges.join(out, "src").select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), (F.col("n") / F.col("all")).alias("part"))
    ways = ways.union(edges.join(back, "dst").select(F.lit("distrust"), "dst", "src", F.col("n") / F.col("all")))
    ways = materialize(ways, "trust-ways")
    least = (seeds.agg(F.min("share")).first()[0] or 0.0) * faintest
    start = seeds.select("kind", "host", (F.col("share") * (1 - damping)).alias("score"))
    state, steps, sum_before = start, 0, 0.0
    # every step adds what has come one link further, at most ``damping`` times the step before; without edges nothing moves
    while not ways.isEmpty() and damping**steps >= least * (1 - damping):
        for _ in range(WRITE_EVERY):
            moved = state.join(ways, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.col("score") * F.col("part") * damping).alias("score"))
            state = moved.union(start).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        steps += WRITE_EVERY
        state = materialize(state, f"trust-step{steps}")
        whole = state.agg(F.sum("score")).first()[0] or 0.0
        if (whole - sum_before) * damping**WRITE_EVERY / (1 - damping**WRITE_EVERY) < least:
            break  # all later steps together add less
        sum_before = whole
    score = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0))
    both = state.groupBy("host").agg(score("trust").alias("trust"), score("distrust").alias("distrust"))
    known = F.col("trust") + F.col("distrust")
    return both.select("host", F.when(known >= least, (F.col("trust") - F.col("distrust")) / known).alias("standing"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, block_below: float = BLOCK_BELOW, faintest: float = FAINTEST, damping: float = DAMPING) -> DataFrame:
    """(page_id, host, path, rule, verdict) of each row of ``pages`` (page_id, url, html)."""
    judged = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": name, "by_rule": verdict})
    counts = judged.filter("by_rule is not null").groupBy("host", "by_rule").agg(F.count("*").alias("n"))
    totals = counts.groupBy("by_rule").agg(F.sum("n").alias("all"))
    kind = F.when(F.col("by_rule") == "allow", "trust").otherwise("distrust").alias("kind")
    seeds = materialize(counts.join(totals, "by_rule").select(kind, "host", (F.col("n") / F.col("all")).alias("share")), "trust-seeds")
    edges = materialize(host_edges(pages), "trust-edges")
    by_host = standings(edges, seeds, faintest, damping)
    out = judged.join(by_host, "host", "left")
    by_method = F.when(F.coalesce(F.col("standing"), F.lit(0.0)) < block_below, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_method).alias("verdict"))


def query(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def oracle() -> str:
    """DuckDB SQL with a recursive CTE; what is too faint to matter stops by itself."""
    fits = [
        (f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')", r)
        for r in sorted(RULES, key=lambda r: -len(r.host + r.path))
    ]
    case = lambda value: "CASE " + " ".join(f"WHEN {f} THEN '{value(r)}'" for f, r in fits) + " END"
    az = f"'{_UPPER}', '{_UPPER.lower()}'"
    link = LINK.replace("'", "''")
    return rf"""
WITH RECURSIVE r AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), {az}) AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM r
), j AS MATERIALIZED (
  SELECT page_id, html, host, path, {case(lambda r: r.host + r.path)} AS rule, {case(lambda r: r.verdict)} AS by_rule FROM h
), seeds AS MATERIALIZED (
  SELECT CASE by_rule WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) / sum(count(*)) OVER (PARTITION BY by_rule) AS share
  FROM j WHERE by_rule IS NOT NULL GROUP BY by_rule, host
), e AS MATERIALIZED (
  SELECT src, dst, count(*) AS n FROM (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), {az}) AS dst FROM j)
  WHERE src <> dst AND src <> '' GROUP BY src, dst
), ways AS MATERIALIZED (
  SELECT 'trust' AS kind, src, dst, n / sum(n) OVER (PARTITION BY src) AS part FROM e
  UNION ALL SELECT 'distrust', dst, src, n / sum(n) OVER (PARTITION BY dst) FROM e
), steps AS (
  SELECT kind, host, share * {1 - DAMPING} AS score FROM seeds
  UNION ALL SELECT s.kind, w.dst, sum(s.score * w.part * {DAMPING}) FROM steps s JOIN ways w ON s.kind = w.kind AND s.host = w.src
  GROUP BY s.kind, w.dst HAVING sum(s.score * w.part * {DAMPING}) > 1e-6 * {FAINTEST} * (SELECT min(share) FROM seeds)
), both_kinds AS (
  SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0) AS t, coalesce(sum(score) FILTER (kind = 'distrust'), 0) AS d FROM steps GROUP BY host
)
SELECT j.page_id, j.host, j.path, j.rule,
       coalesce(by_rule, CASE WHEN t + d >= {FAINTEST} * (SELECT min(share) FROM seeds) AND (t - d) / (t + d) < {BLOCK_BELOW} THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN both_kinds b ON j.host = b.host
"""
