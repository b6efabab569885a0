"""URL filters: pattern rules, each kept under its rarest literal token, so that a URL runs only the rules its tokens fetch."""

from __future__ import annotations

import string
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"

#: Host, path, and what follows them, behind the first ``://``.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$"
TOKEN = "[0-9a-z]+"
#: A token of a pattern that must be a whole token of every URL the pattern matches: ``*`` may not extend it.
WHOLE = "(?<![0-9a-z*])[0-9a-z]+(?![0-9a-z*])"
SEPARATOR = r"(?:[^0-9A-Za-z_.%-]|\z)"

#: Places a token may have in one slot of the join with the rules; a more frequent one is dealt to several.
HOT_ROWS = 1_000_000
#: Most rules that may have no whole token; those run on every URL, inside the plan.
TOKENLESS = 200


def lower(text: Column) -> Column:
    """A-Z only."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and subject of a URL. All are empty for NULL and without ``://``.

    The subject is a dot, the host and all behind it, so that every label of the host begins with a dot.
    """
    part = lambda k: F.coalesce(F.regexp_extract(url, PARTS, k), F.lit(""))
    host = lower(part(1))
    return host, part(2), F.when(url.contains("://"), F.concat(F.lit("."), host, part(2), part(3))).otherwise("")


def host_rules(rules: Iterable[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    """``(rule, pattern, verdict)`` for (verdict, host, path): the host and its subdomains, all paths that begin with ``path``."""
    found = []
    for verdict, host, path in rules:
        if not path.startswith("/") or set(host + path) & set("*^|?#"):
            raise ValueError(f"no host and path: {host}{path}")
        found.append((host + path, f"||{host.lower()}{path}", verdict))
    return found


def rule_table(spark: SparkSession, *tiers: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``rule, pattern, verdict, tier`` from lists of (rule, pattern, verdict); earlier lists come before later ones."""
    rows = [(*rule, tier) for tier, rules in enumerate(tiers) for rule in rules]
    return spark.createDataFrame(rows, "rule string, pattern string, verdict string, tier int")


def compiled(rules: DataFrame) -> DataFrame:
    """Rules with their regular expression on subjects (``regex``) and their whole tokens (``tokens``).

    In a pattern ``||`` at the front stands for the begin of the host or of one of its labels, ``|`` for the begin or end of the subject,
    ``*`` for any characters and ``^`` for a separator or the end. All else stands for itself.
    """
    p = F.col("pattern")
    label, front = p.startswith("||"), p.startswith("|")
    start = F.when(label, 3).when(front, 2).otherwise(1)
    end = p.endswith("|") & (F.length(p) >= start)
    rules = rules.withColumn("body", F.substr(p, start, F.length(p) - start + 1 - end.cast("int")))
    quoted = F.regexp_replace("body", r"([\\.\[\]{}()+?$|])", r"\\$1")
    quoted = F.replace(F.replace(quoted, F.lit("^"), F.lit(SEPARATOR)), F.lit("*"), F.lit(".*"))
    begin = F.when(label, r"^[^/?#]*\.").when(front, r"^\.").otherwise("")
    edges = F.concat(F.when(front, ".").otherwise("*"), lower(F.col("body")), F.when(end, ".").otherwise("*"))
    return rules.select(
        "rule", "pattern", "verdict", "tier",
        F.concat(F.lit("(?s)"), begin, quoted, F.when(end, r"\z").otherwise("")).alias("regex"),
        F.array_distinct(F.regexp_extract_all(edges, F.lit(WHOLE), 0)).alias("tokens"),
    )


def _tokens(urls: DataFrame) -> DataFrame:
    tokens = F.array_distinct(F.regexp_extract_all(lower(F.col("subject")), F.lit(TOKEN), 0))
    return urls.select("url", "subject", F.explode(tokens).alias("token"))


def rarest(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The index: every rule of ``compiled`` with a token, under the token that the fewest ``urls`` have, and how many (``places``).

    All URLs are counted, by partial sums, and only for tokens of rules. Of equally rare tokens the longest is taken, then the first.
    """
    named = rules.select(F.struct("rule", "pattern", "verdict", "tier", "regex").alias("held"), F.explode("tokens").alias("token"))
    named = named.distinct()
    seen = _tokens(urls).join(named.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("places"))
    counted = named.join(seen, "token", "left").withColumn("places", F.coalesce("places", F.lit(0)))
    least = F.min(F.struct("places", -F.length("token"), "token"))
    return counted.groupBy("held").agg(least.alias("least")).select("held.*", "least.token", "least.places")


def candidates(urls: DataFrame, index: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every URL beside the rules that one of its tokens fetches.

    Spark broadcasts a small index; else both sides are shuffled by token, and a token at more than ``hot_rows`` places is
    dealt to as many slots as it has such lots, its rules being repeated in each. The broadcast list of those has at most
    one row for ``hot_rows`` places.
    """
    slots = F.floor(F.col("places") / hot_rows) + 1
    hot = index.filter(F.col("places") >= hot_rows).select("token", slots.alias("slots")).distinct()
    dealt = _tokens(urls).join(F.broadcast(hot), "token", "left")
    dealt = dealt.withColumn("slot", F.pmod(F.xxhash64("url"), F.coalesce("slots", F.lit(1))))
    held = index.filter("places > 0").withColumn("slot", F.explode(F.sequence(F.lit(0).cast("bigint"), slots - 1)))
    return dealt.join(held, ["token", "slot"]).select("url", "subject", "rule", "pattern", "verdict", "tier", "regex")


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW, url: str = "url", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``row`` (a struct of all columns of ``pages``), ``host, path, rule, tier, verdict``, one row for each row of ``pages``.

    ``rules`` as from :func:`rule_table`. Of the rules that match a URL, one of the lowest tier decides; there the longest
    pattern, then ``block`` before ``allow``, then the least rule. Without one, ``rule`` and ``tier`` are NULL and the verdict is ``default``; NULL
    and empty URLs and those without ``://`` match nothing. URLs that repeat are judged once. Empty tables and rule sets are
    fine. Rules without a whole token run on every URL; more than ``TOKENLESS`` of them are an error.
    """
    given = pages.select(F.struct("*").alias("row"), F.col(url).cast("string").alias("url"))
    urls = given.select("url").filter(F.col("url").contains("://")).distinct().select("url", parts(F.col("url"))[2].alias("subject"))
    rules = compiled(rules)
    loose = rules.filter(F.size("tokens") == 0).drop("tokens").distinct().limit(TOKENLESS + 1).collect()
    if len(loose) > TOKENLESS:
        raise ValueError(f"over {TOKENLESS} rules without a whole token, such as {loose[0]['pattern']}")
    run = candidates(urls, rarest(urls, rules), hot_rows).filter(F.rlike("subject", F.col("regex")))
    for rule in loose:
        fits = urls.filter(F.rlike("subject", F.lit(rule["regex"])))
        run = run.union(fits.select("url", "subject", *[F.lit(rule[c]).alias(c) for c in ("rule", "pattern", "verdict", "tier", "regex")]))
    order = F.struct("tier", -F.length("pattern"), F.col("verdict") != BLOCK, "rule", "verdict")
    best = run.groupBy("url").agg(F.min(order).alias("best")).select("url", "best.rule", "best.tier", "best.verdict")
    host, path, _ = parts(F.col("url"))
    verdict = F.coalesce("verdict", F.lit(default)).alias("verdict")
    return given.join(best, "url", "left").select("row", host.alias("host"), path.alias("path"), "rule", "tier", verdict)
