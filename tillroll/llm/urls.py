"""URL filtering by host-suffix and path-prefix expressions.

A rule names a host and a path start. Every URL is expanded into the
expressions that could be rules: each suffix of its host, label by label,
with each start of its path whose length some rule has. Expressions meet
rules in an equi-join on the first 32 bits of their SHA-256; the full digest
confirms the match, and the longest rule wins (for equal lengths the longer
host, then block before allow).

Only distinct (host, path start) expressions take part in the join, so a
host that a third of all URLs share meets the rules once per task. Functions
of Spark only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import unused

DEFAULT_VERDICT = "allow"
#: Rules that are broadcast; with a path of at most MAX_PATH characters the
#: table stays under 64 MB. More rules, or longer ones, are shuffled.
BROADCAST_RULES = 100_000
MAX_PATH = 500


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    lower = F.translate(_after(url), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract(lower, r"^([^/?#]*)", 1)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _suffixes(host: Column) -> Column:
    """Every host a rule may name: from each label to the end."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def judge_urls(urls: DataFrame, rules: DataFrame, column: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """``urls`` with host, path, rule and verdict.

    ``rules``: host (as in lower-cased URLs), path (a literal start) and
    verdict ("allow" or "block"). A rule fits its host and all subdomains if
    the URL's path starts with its path. Defined results: a null URL or one
    without ``://`` has an empty host and path and fits no rule but one for
    the empty host; where no rule fits, rule is null and the verdict
    ``default``; repeated rules count once; with no rules every URL gets
    ``default``. Columns of ``urls`` with a result's name are replaced."""
    urls = urls.drop("host", "path", "rule", "verdict") if column not in ("host", "path", "rule", "verdict") else urls
    rules = rules.select("host", "path", "verdict").na.drop().distinct()
    spread = rules.groupBy(F.length("path").alias("n")).agg(F.count(F.lit(1)).alias("rules"), F.max(F.length("host")).alias("host")).collect()
    lengths = sorted(r["n"] for r in spread)  # distinct lengths of rule paths
    small = sum(r["rules"] for r in spread) <= BROADCAST_RULES and all(r["n"] + r["host"] <= MAX_PATH for r in spread)
    host, path = unused("__host", urls), unused("__path", urls)
    judged = urls.withColumn(host, host_of(F.col(column).cast("string"))).withColumn(path, path_of(F.col(column).cast("string")))
    # the part of the path that rules can see: URLs that differ beyond it are
    # one expression set
    seen = judged.select(F.col(host).alias("host"), F.left(path, F.lit(max(lengths, default=0))).alias("head")).distinct()
    fits = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("head"))
    expanded = seen.withColumn("suffix", F.explode(_suffixes(F.col("host")))).withColumn("n", F.explode(fits))
    expanded = expanded.select("host", "head", F.sha2(F.concat_ws("\n", "suffix", F.left("head", F.col("n"))), 256).alias("digest"))
    listed = rules.select(
        F.sha2(F.concat_ws("\n", "host", "path"), 256).alias("r_digest"),
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"),
        F.col("verdict").alias("r_verdict"),
    )
    met = expanded.join(
        F.broadcast(listed) if small else listed,
        (F.substring("digest", 1, 8) == F.substring("r_digest", 1, 8)) & (F.col("digest") == F.col("r_digest")),
    )
    order = F.struct(F.length("rule"), "host_length", (F.col("r_verdict") == "block").cast("int"))
    won = met.groupBy("host", "head").agg(F.max_by(F.struct("rule", "r_verdict"), order).alias("won"))
    won = won.select(F.col("host").alias("w_host"), F.col("head").alias("w_head"), F.col("won.rule").alias("rule"), F.col("won.r_verdict").alias("w_verdict"))
    # dealt anew, so that the join has an exchange on both sides and Spark can
    # split the partition of a frequent host
    won = won.hint("rebalance")
    same = (F.col(host) == F.col("w_host")) & (F.left(path, F.lit(max(lengths, default=0))) == F.col("w_head"))
    out = judged.join(won, same, "left")
    return out.select(
        *[urls[c] for c in urls.columns],
        F.col(host).alias("host"),
        F.col(path).alias("path"),
        "rule",
        F.coalesce("w_verdict", F.lit(default)).alias("verdict"),
    )
