"""URL filter: rules first, then trust and distrust spread over host links.

Rules name a host (with its subdomains) and a path prefix. Hosts of pages that a
rule allows are trusted seeds, hosts of pages that a rule blocks are blocked
seeds, each weighted by its number of such pages. Trust is a personalised
PageRank along the links between hosts; distrust is one along the reversed links
(who links to a bad host is suspect). A host whose distrust exceeds its trust by
``margin`` is blocked, any other allowed; pages without a rule get their host's
verdict.

Links come from absolute ``href`` targets in the pages. They are counted per
host pair before anything is joined, so one host with very many pages is a few
rows by then. Walks stop at hosts without links; the lost mass is not returned.

Cases: a null url or one without ``://`` has an empty host and path, no rule and
a neutral host; a null html has no links; repeated pages weigh double; an empty
table gives none; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casequarry.session import cut

# Fixed rules of the task: verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
DAMPING = 0.85
ROUNDS = 10
MARGIN = 1e-9
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """src, dst, n: links between different hosts, counted."""
    links = F.explode(F.regexp_extract_all("html", F.lit(r"""href\s*=\s*["']([A-Za-z][A-Za-z0-9+.-]*://[^"']*)["']"""), 1))
    found = pages.select(host_and_path(F.col("url"))[0].alias("src"), links.alias("link"))
    return (found.select("src", host_and_path(F.col("link"))[0].alias("dst"))
            .where("src != dst and src != '' and dst != ''").groupBy("src", "dst").agg(F.count("*").alias("n")))


def personalised_rank(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS,
                      reverse: bool = False) -> DataFrame:
    """host, score after ``rounds`` steps of a walk that restarts at ``seeds`` (host, weight)."""
    src, dst = ("dst", "src") if reverse else ("src", "dst")
    out_weight = links.groupBy(F.col(src).alias("__from")).agg(F.sum("n").alias("__all"))
    steps = cut(links.select(F.col(src).alias("__from"), F.col(dst).alias("__to"), "n")
                .join(out_weight, "__from").select("__from", "__to", (F.col("n") / F.col("__all")).alias("__share")))
    score = seeds.select("host", F.col("weight").cast("double").alias("score"))
    if steps.isEmpty():
        return score.select("host", (F.col("score") * (1 - damping)).alias("score"))
    restart = score.select("host", (F.col("score") * (1 - damping)).alias("score"))
    for k in range(rounds):
        moved = score.join(steps, score["host"] == steps["__from"]).select(
            F.col("__to").alias("host"), (F.col("score") * F.col("__share") * damping).alias("score"))
        score = moved.unionByName(restart).groupBy("host").agg(F.sum("score").alias("score"))
        if k % 3 == 2:
            score = cut(score)
    return score


def judge(pages: DataFrame, rules=RULES, damping: float = DAMPING, rounds: int = ROUNDS, margin: float = MARGIN) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and its host's trust and distrust."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    name, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    judged = parsed.withColumns({"rule": name, "ruled": verdict})
    counts = cut(judged.where("ruled is not null").groupBy("ruled", "host").agg(F.count("*").alias("n")))
    totals = {r["ruled"]: r["n"] for r in counts.groupBy("ruled").agg(F.sum("n").alias("n")).collect()}
    links = cut(host_links(pages))

    def seeds(kind):
        return counts.where(F.col("ruled") == kind).select("host", (F.col("n") / totals.get(kind, 1)).alias("weight"))

    trust = personalised_rank(links, seeds("allow"), damping, rounds)
    distrust = personalised_rank(links, seeds("block"), damping, rounds, reverse=True)
    scores = cut(trust.withColumnRenamed("score", "trust").join(distrust.withColumnRenamed("score", "distrust"), "host", "full")
                 .fillna(0.0, ["trust", "distrust"]))
    by_host = F.when(F.col("distrust") > F.col("trust") + margin, "block").otherwise("allow")
    return judged.join(scores, "host", "left").fillna(0.0, ["trust", "distrust"]).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"), "trust", "distrust")
