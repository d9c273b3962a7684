"""URL filters: rules by host and path, and for the rest a verdict from trust that flows over the host graph.

Host edges come from absolute links of the pages and from each host to its parent domain and back. Personalised PageRank
starts at hosts with allowed pages; distrust starts at hosts with blocked pages and runs against the edges. What reaches a
host without way on returns to the seeds. A host whose distrust outweighs its trust is blocked. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapvault.session import settled

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROUNDS = 4  # planned together: edges are shuffled once for all of them, and one table is written
# Fixed value: linked pairs and hosts with rules, some 100 bytes each, up to which the graph takes one partition and so needs no
# shuffle. Adaptive execution would merge as much anyway, but only after the driver has planned and run several stages a round.
SMALL_GRAPH = 50_000
LINK = r"""(?i)\shref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffixes(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    *,
    page: str = "page_id",
    url: str = "url",
    html: str = "html",
    tolerance: float = 1e-4,
    damping: float = 0.85,
    distrust_weight: float = 1.0,
) -> DataFrame:
    """``page``, ``host``, ``path``, ``rule``, ``verdict`` and the host's ``trust`` and ``distrust`` for every page row.

    ``rules`` has host, path and verdict (allow or block); a rule fits its host and subdomains where the path starts with
    the rule's. The longest fitting rule wins, of equally long ones the greater text, and of one text ``block``. Rules with a
    null in them are left out. A page without host (null url, no ``://``) fits no rule and is blocked; null html has no
    links. Repeated rows are judged one by one. No pages: no rows. Scores flow until every host that can be reached has some
    and rounds add less than ``tolerance`` of either score's whole. A chain of links takes as many rounds as it is long.
    """
    parts = pages.select(
        F.col(f"`{page}`").alias("page"),
        url_host(F.col(f"`{url}`").cast("string")).alias("host"),
        url_path(F.col(f"`{url}`").cast("string")).alias("path"),
    )
    hosts = settled(_host_rules(parts, rules), "url-hosts")
    ruled = _ruled(parts, hosts)
    links = pages.select(
        url_host(F.col(f"`{url}`").cast("string")).alias("src"),
        F.explode(F.array_distinct(F.regexp_extract_all(F.col(f"`{html}`").cast("string"), F.lit(LINK), 1))).alias("link"),
    )
    scores = host_scores(ruled, links, tolerance=tolerance, damping=damping)
    known = hosts.join(scores, "host", "left").na.fill(0.0, ["trust", "distrust"])
    blocked = (F.col("host") == "") | (F.col("distrust") * distrust_weight > F.col("trust"))
    known = known.withColumn("by_graph", F.when(blocked, "block").otherwise("allow"))
    best = _best_rule()
    return parts.join(known, "host").select(
        F.col("page").alias(page),
        "host",
        "path",
        best["rule"].alias("rule"),
        F.coalesce(best["verdict"], F.col("by_graph")).alias("verdict"),
        "trust",
        "distrust",
    )


def _host_rules(parts: DataFrame, rules: DataFrame) -> DataFrame:
    """Every host once, with the rules of itself and its parent domains, and how many pages it has."""
    own = rules.select("host", "path", "verdict").dropna().dropDuplicates()
    own = own.groupBy(F.translate("host", UPPER, LOWER).alias("suffix")).agg(
        F.collect_list(
            F.struct(F.length(F.concat("host", "path")).alias("n"), F.concat("host", "path").alias("rule"), "verdict", "path")
        ).alias("own")
    )
    hosts = parts.groupBy("host").agg(F.count("*").alias("n_pages"))
    found = hosts.select("host", "n_pages", F.explode(_suffixes(F.col("host"))).alias("suffix")).join(own, "suffix", "left")
    return found.groupBy("host").agg(
        F.max("n_pages").alias("n_pages"), F.flatten(F.collect_list("own")).alias("rules")
    )


def _best_rule() -> Column:
    return F.array_max(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"])))


def _ruled(parts: DataFrame, hosts: DataFrame) -> DataFrame:
    """Pages allowed and blocked by rules, by host."""
    verdict = _best_rule()["verdict"]
    some = hosts.filter(F.size("rules") > 0).select("host", "rules")
    # Written before they are counted: one host may have a third of all pages, and a join that is grouped at once by its own key
    # cannot be split.
    flags = settled(parts.join(some, "host").select("host", verdict.alias("verdict")), "url-ruled")
    verdict = F.col("verdict")
    by_host = flags.groupBy("host").agg(
        F.sum((verdict == "allow").cast("double")).alias("allowed"), F.sum((verdict == "block").cast("double")).alias("blocked")
    )
    return by_host.na.fill(0.0)


def _sums(state: DataFrame) -> dict[str, tuple[float, int]]:
    """Whole and number of hosts of each kind that has any."""
    kinds = ("trust", "distrust")
    of = lambda kind: F.col("kind") == kind
    sums = [c for k in kinds for c in (F.sum(F.when(of(k), F.col("s"))), F.count_if(of(k)))]
    row = state.agg(*sums).head()
    return {k: (row[2 * i], row[2 * i + 1]) for i, k in enumerate(kinds) if row[2 * i + 1]}


def host_scores(ruled: DataFrame, links: DataFrame, *, tolerance: float, damping: float) -> DataFrame:
    """``host``, ``trust``, ``distrust`` of hosts that any seed reaches; each sums to 1 where it has a seed.

    Rounds start from the seeds' own share and only add to it, so the sum tells how much is still to come. Returning what
    hosts without way on receive to the seeds only scales all scores of a kind, so that is done once, at the end.
    """
    away = links.select("src", url_host(F.regexp_replace("link", r"^(//)", "http://")).alias("dst"))
    away = away.filter("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("w"))
    away, ruled = settled(away, "url-links"), settled(ruled, "url-seeds")
    small = away.count() + ruled.count() <= SMALL_GRAPH
    dealt = lambda df: df.coalesce(1) if small else df
    kept = lambda df, label: dealt(settled(df, label))
    away, ruled = dealt(away), dealt(ruled)
    known = dealt(ruled.select("host").union(away.select("src")).union(away.select("dst"))).distinct()
    parents = known.select("host", F.explode(_suffixes(F.col("host"))).alias("up")).filter("contains(up, '.')")
    parents = kept(parents.select(F.explode(_suffixes(F.col("up"))).alias("host")).distinct(), "url-parents")
    parents = parents.select("host", F.substring_index("host", ".", -1).alias("top"), F.regexp_replace("host", r"^[^.]*\.", "").alias("up"))
    parents = parents.filter("up <> top and contains(host, '.')")
    kin = parents.select(F.col("host").alias("src"), F.col("up").alias("dst")).union(parents.select("up", "host"))
    edges = kept(dealt(away.union(kin.withColumn("w", F.lit(1.0)))).groupBy("src", "dst").agg(F.sum("w").alias("w")), "url-kin")
    edges = edges.select(F.lit("trust").alias("kind"), "src", "dst", "w").union(
        edges.select(F.lit("distrust"), F.col("dst"), F.col("src"), "w")
    )
    edges = dealt(edges)
    shares = edges.join(edges.groupBy("kind", "src").agg(F.sum("w").alias("total")), ["kind", "src"])
    shares = kept(shares.select("kind", "src", "dst", (F.col("w") / F.col("total")).alias("share")), "url-edges")
    seeds = ruled.select(F.lit("trust").alias("kind"), "host", F.col("allowed").alias("s")).union(
        ruled.select(F.lit("distrust"), "host", "blocked")
    )
    seeds = dealt(seeds.filter("s > 0"))
    totals = {kind: total for kind, (total, _) in _sums(seeds).items()}
    scale = F.when(F.col("kind") == "trust", F.lit(totals.get("trust") or 1.0)).otherwise(F.lit(totals.get("distrust") or 1.0))
    seeds = kept(seeds.withColumn("s", F.col("s") / scale), "url-seeds")
    state = base = seeds.withColumn("s", F.col("s") * (1 - damping))
    before: dict[str, tuple[float, int]] = {}
    while True:
        for _ in range(ROUNDS):
            moved = state.select("kind", F.col("host").alias("src"), "s").join(shares, ["kind", "src"])
            moved = moved.select("kind", F.col("dst").alias("host"), (F.col("s") * F.col("share") * damping).alias("s"))
            state = dealt(moved.union(base)).groupBy("kind", "host").agg(F.sum("s").alias("s"))
        state = kept(state, "url-scores")
        now = _sums(state)
        if all(k in before and n == before[k][1] and s - before[k][0] <= tolerance * s for k, (s, n) in now.items()):
            break
        before = now
    whole = F.when(F.col("kind") == "trust", now.get("trust", (1.0,))[0]).otherwise(now.get("distrust", (1.0,))[0])
    state = state.withColumn("s", F.col("s") / whole)
    return state.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("s"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("s"))), F.lit(0.0)).alias("distrust"),
    )


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def query(spark, sf_dir):
    from snapvault.llm.common import read

    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(read(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")
