"""Url verdicts: path rules first, then trust and distrust spread over links between hosts.

Trust is personalised PageRank from the hosts whose pages the rules allow; distrust is
personalised PageRank over the reversed links from the hosts whose pages they block. A
host is blocked when its distrust per page exceeds its trust by a margin.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakejobs.llm.common import forget, kept

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Targets of absolute and scheme-relative links.
LINKS = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""
# Rows of ranks that a task writes.
HOSTS_PER_FILE = 500_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    pattern: str  # host, a slash and the start of a path

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host) :]


@dataclass(frozen=True)
class Settings:
    """``margin``: a host is blocked when its distrust exceeds its trust by more than this.

    Both are counted per page of the host, in units of what a page that a rule judges puts
    in, so 0.5 blocks an unlinked host when rules block more than half of its pages, net of
    those they allow. Rounds go on until no host changes by more than ``tolerance`` in
    these units; ``rounds`` is the limit at which an error is raised.
    """

    damping: float = 0.85
    rounds: int = 200
    margin: float = 0.5
    tolerance: float = 0.001


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path; both empty for NULL and for urls without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Pattern and verdict of the longest rule that fits, else NULL; block wins a tie."""
    pattern, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.verdict == BLOCK)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(
            path, F.lit(rule.path)
        )
        pattern = F.when(fits, F.lit(rule.pattern)).otherwise(pattern)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return pattern, verdict


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``src``, ``dst`` and ``n``: links between different hosts.

    Links are the absolute ones in the pages. Besides, every host and its parent domain
    (down to two labels) link to each other once, as a domain answers for its subdomains;
    without that, hosts that no page links to could not be judged.
    """
    src = host_and_path(F.col(url_col))[0]
    found = pages.select(src.alias("src"), F.col(html_col).alias("__html")).where("src != ''")
    targets = F.array_distinct(F.regexp_extract_all("__html", F.lit(LINKS), F.lit(1)))
    links = (
        found.select("src", F.explode(targets).alias("dst"))
        .select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
        .where("src != dst and dst != ''")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    links = kept(links, "host-links")
    hosts = found.select(F.col("src").alias("host")).union(links.select("dst")).distinct()
    labels = F.split("host", r"\.")
    depth = F.size(labels)
    ups = F.transform(
        F.sequence(F.lit(0), F.greatest(depth - 3, F.lit(0))),
        lambda i: F.struct(
            F.concat_ws(".", F.slice(labels, i + 1, depth)).alias("a"),
            F.concat_ws(".", F.slice(labels, i + 2, depth)).alias("b"),
        ),
    )
    tree = (
        hosts.where(depth >= 3).select(F.explode(ups).alias("e")).select("e.a", "e.b").distinct()
    )
    one = F.lit(1.0).alias("n")
    both = tree.select(F.col("a").alias("src"), F.col("b").alias("dst"), one).union(
        tree.select(F.col("b").alias("src"), F.col("a").alias("dst"), one)
    )
    return links.union(both).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def spread(edges: DataFrame, seeds: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``host``, ``trust`` and ``distrust`` when they no longer change.

    ``edges``: src, dst, n. ``seeds``: host, trust, distrust (weights of any scale), pages.
    Hosts that nothing reaches are absent; what arrives at a host without links ends there.
    """
    pages = seeds.select("host", "pages")
    forward = edges.select(F.lit(ALLOW).alias("kind"), "src", "dst", "n")
    backward = edges.select(
        F.lit(BLOCK).alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"
    )
    links = kept(forward.union(backward), "host-moves")
    out = kept(links.groupBy("kind", "src").agg(F.sum("n").alias("total")), "host-degrees")
    # What moves to a host carries its pages, so that a round needs no lookup of them.
    shares = links.join(out, ["kind", "src"]).select(
        "kind", "src", F.col("dst").alias("host"), (F.col("n") / F.col("total")).alias("share")
    )
    moves = kept(shares.join(pages, "host", "left").select("kind", "src", "host", "share", "pages"), "host-shares")
    start = kept(
        seeds.select(F.lit(ALLOW).alias("kind"), "host", F.col("trust").alias("rank"), "pages")
        .union(seeds.select(F.lit(BLOCK).alias("kind"), "host", F.col("distrust").alias("rank"), "pages"))
        .where("rank > 0"),
        "host-seeds",
    )
    n_links = links.count()
    files = 1 + n_links // HOSTS_PER_FILE
    forget(links, out)
    seeded = start.select("kind", "host", F.col("rank") * (1 - settings.damping), F.lit(0.0), "pages")
    ranks = start
    for _ in range(settings.rounds):
        was = ranks.withColumnRenamed("host", "src").select("kind", "src", "rank")
        moved = moves.join(was, ["kind", "src"]).select(
            "kind", "host", (F.col("rank") * F.col("share") * settings.damping).alias("rank"), F.lit(0.0).alias("was"), "pages"
        )
        old = ranks.select("kind", "host", F.lit(0.0), F.col("rank"), "pages")
        now = (
            moved.union(seeded)
            .union(old)
            .groupBy("kind", "host")
            .agg(F.sum("rank").alias("rank"), F.sum("was").alias("was"), F.max("pages").alias("pages"))
        )
        change = F.abs(F.col("rank") - F.col("was")) / F.coalesce("pages", F.lit(1)) / (1 - settings.damping)
        seen = Observation()
        now = now.coalesce(files).observe(seen, F.max(change).alias("change"))
        before, ranks = ranks, kept(now, "host-ranks")
        if before is not start:
            forget(before)
        if (seen.get["change"] or 0) <= settings.tolerance:
            break
    else:
        raise RuntimeError(f"host ranks have not converged after {settings.rounds} rounds")
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0.0))
    return ranks.groupBy("host").agg(of(ALLOW).alias("trust"), of(BLOCK).alias("distrust"))


def seeds_of(judged: DataFrame) -> DataFrame:
    """Per host its pages, and the seed weights: its pages that a rule allows or blocks."""
    n = lambda v: F.count(F.when(F.col("__rule_verdict") == v, 1)).cast("double")
    return (
        judged.where("host != ''")
        .groupBy("host")
        .agg(n(ALLOW).alias("trust"), n(BLOCK).alias("distrust"), F.count(F.lit(1)).alias("pages"))
    )


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    settings: Settings = Settings(),
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``id_col``, host, path, rule, verdict, trust and distrust of every row.

    The longest rule that fits decides; else the host's trust and distrust do, and a host
    that neither reaches (as that of a NULL or malformed url) is allowed. NULL and empty
    html has no links. Repeated rows are judged alike, each with its row; other columns are
    not read.
    """
    host, path = host_and_path(F.col(url_col))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = kept(
        pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
        .withColumn("rule", rule)
        .withColumn("__rule_verdict", verdict),
        "judged-pages",
    )
    seeds = kept(seeds_of(judged), "host-pages")
    ranks = spread(host_edges(pages, url_col, html_col), seeds, settings)
    hosts = kept(
        seeds.select("host", "pages")
        .join(ranks, "host", "left")
        .select(
            "host",
            *[
                (F.coalesce(c, F.lit(0.0)) / F.col("pages") / (1 - settings.damping)).alias(c)
                for c in ("trust", "distrust")
            ],
        ),
        "host-trust",
    )
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    method = F.when(distrust - trust > settings.margin, BLOCK).otherwise(ALLOW)
    return judged.join(hosts, "host", "left").select(
        id_col,
        "host",
        "path",
        "rule",
        F.coalesce("__rule_verdict", method).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
