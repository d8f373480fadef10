"""URL filter: host and path rules first, then trust and distrust along the links between hosts.

Every url is judged by the longest rule that fits it. Hosts on which rules allow or block pages are
the seeds of two propagations over host edges, both personalised PageRank without the constant
1 - damping, so that a score reads as a share of a host's surroundings:

    trust(h)    = allowed share of h's pages + damping * sum over links g -> h of w(g, h) * trust(g)
    distrust(h) = blocked share of h's pages + damping * sum over links h -> g of w(h, g) * distrust(g)

w(g, h) is the share of g's outgoing links that go to h; links within a host count for nothing. So
trust flows along links, distrust against them. A url that no rule fits is blocked if its host's
distrust reaches `threshold` and exceeds its trust, else allowed.

Hosts are graph nodes, and edges are counted before any shuffle, so a host with a third of all pages
is a few rows per task. Joins are left to Spark, which splits skewed sides. Each step is written to the
shared folder.

Defined results: a null url or one without `://` has an empty host and path, which no rule fits and
which the graph ignores: it is allowed. A null html has no links. Repeated pages count as often as they
come. An empty table gives no rows.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.llm.common import ascii_lower, discard, prepare, stored, table

#: Action and rule, a host and the beginning of a path.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)

_LINK = r"""(?i)<a\s[^>]*?\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Propagation:
    """Stops once no score moves by more than `tolerance`; damping bounds the steps by `steps`."""

    damping: float = 0.85
    tolerance: float = 1e-4
    steps: int = 60
    threshold: float = 0.5


PRODUCTION = Propagation()


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(host: Column, path: Column, rule: str) -> Column:
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)


def matching_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits and its action, null if none fits."""
    longest = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    nothing = F.lit(None).cast("string")
    pick = lambda value: F.coalesce(
        *[F.when(_fits(host, path, rule), F.lit(value(action, rule))) for action, rule in longest],
        nothing,
    )
    return pick(lambda _, rule: rule), pick(lambda action, _: action)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): the share of src's links to other hosts that go to dst."""
    links = (
        pages.where(F.col("host") != "")
        .select(
            F.col("host").alias("src"),
            F.explode(F.regexp_extract_all("html", F.lit(_LINK), 1)).alias("dst"),
        )
        .select("src", ascii_lower(F.col("dst")).alias("dst"))
        .where(F.col("src") != F.col("dst"))
        .groupBy("src", "dst")
        .agg(F.count("*").alias("links"))
    )
    out = links.groupBy("src").agg(F.sum("links").alias("all_links"))
    return links.join(out, "src").select(
        "src", "dst", (F.col("links") / F.col("all_links")).alias("weight")
    )


def host_scores(seeds: DataFrame, edges: DataFrame, how: Propagation = PRODUCTION) -> DataFrame:
    """(host, trust, distrust) for all hosts that are seeds or that links reach.

    `seeds` has host, allowed and blocked, both shares from 0 to 1.
    """
    spark = seeds.sparkSession
    edges, edges_path = stored(edges, "host-edges")
    base = seeds.select(
        F.col("host").alias("host"), F.col("allowed").alias("trust"), F.col("blocked").alias("distrust")
    )
    base, base_path = stored(base, "host-seeds")
    scores, path = base, None
    for _ in range(how.steps):
        zero = F.lit(0.0)
        along = edges.join(scores, F.col("src") == F.col("host")).select(
            F.col("dst").alias("host"),
            (F.col("weight") * F.col("trust") * how.damping).alias("trust"),
            zero.alias("distrust"),
        )
        against = edges.join(scores, F.col("dst") == F.col("host")).select(
            F.col("src").alias("host"),
            zero.alias("trust"),
            (F.col("weight") * F.col("distrust") * how.damping).alias("distrust"),
        )
        old = scores.select(
            "host", zero.alias("trust"), zero.alias("distrust"),
            F.col("trust").alias("old_trust"), F.col("distrust").alias("old_distrust"),
        )
        parts = base.unionByName(along).unionByName(against).unionByName(old, allowMissingColumns=True)
        moved = parts.groupBy("host").agg(
            *[F.sum(c).alias(c) for c in ("trust", "distrust", "old_trust", "old_distrust")]
        )
        change = F.greatest(
            *[F.abs(F.col(c) - F.coalesce(f"old_{c}", zero)) for c in ("trust", "distrust")]
        )
        step, step_path = stored(moved.select("host", "trust", "distrust", change.alias("change")), "hosts")
        largest = step.agg(F.max("change")).first()[0] or 0.0
        if path:
            discard(spark, path)
        scores, path = step.drop("change"), step_path
        if largest <= how.tolerance:
            break
    discard(spark, edges_path, base_path)
    return scores


def judged_urls(pages: DataFrame, rules=RULES, how: Propagation = PRODUCTION) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, trust, distrust) of pages with page_id, url, html."""
    prepare(pages.sparkSession)
    parsed = pages.select(
        "page_id", "url", "html", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    rule, action = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumns({"rule": rule, "action": action})
    share = lambda name: F.avg(
        F.when(F.coalesce("action", F.lit("")) == name, 1.0).otherwise(0.0)
    )
    seeds = (
        ruled.where(F.col("host") != "")
        .groupBy("host")
        .agg(share("allow").alias("allowed"), share("block").alias("blocked"))
    )
    scores = host_scores(seeds, host_edges(parsed), how)
    distrusted = (F.col("distrust") >= how.threshold) & (F.col("distrust") > F.col("trust"))
    by_links = F.when(distrusted, "block").otherwise("allow")
    return ruled.join(scores, "host", "left").select(
        "page_id", "url", "host", "path", "rule",
        F.coalesce("action", by_links).alias("verdict"),
        "trust", "distrust",
    )


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return judged_urls(pages).drop("url")


QUERIES = {"op2_url_filter": op2_url_filter}
ORACLE_SQL: dict[str, str] = {}
