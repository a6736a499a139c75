"""URL filter by the ratio of two character models, one of accepted and one of rejected URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import name_in, refuse, saved, without

#: A character is judged by up to four before it.
ORDER = 5
#: Stand before the first character and after the last.
BEGIN, END = "\x02", "\x03"
#: Grams up to which the ratios are broadcast (some 50 MB); a larger table is joined by shuffling, each ratio ``SALTS`` times, so that a frequent gram is spread.
MOST_BROADCAST, SALTS = 500_000, 16
RESULTS = ("host", "path", "rule", "score", "verdict")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; empty if null or without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty if null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest of the rules ``host/path`` that fits: its host or a subdomain of it, and a path that begins with its path."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        of_host, slash, rest = rule.partition("/")
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def letters(url: Column) -> Column:
    """The lower-cased characters after the scheme, delimiters and other scripts as they are, between four begins and an end."""
    rest = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)^.*?://", ""))
    return F.concat(F.array(*[F.lit(BEGIN)] * (ORDER - 1)), F.regexp_extract_all(rest, F.lit("(?s)."), 0), F.array(F.lit(END)))


def _grams(urls: DataFrame, *kept: str) -> DataFrame:
    """``gram`` for each character of each URL and its end: itself after the four before it."""
    # The letters are a column first: inside the expression that reads them by place they would be made anew for each place.
    spelled = urls.select(*kept, letters(F.col("url")).alias("letters"))
    at = lambda i: F.concat(*[F.get("letters", i + k) for k in range(ORDER)])
    return spelled.select(*kept, F.explode(F.transform(F.sequence(F.lit(0), F.size("letters") - ORDER), at)).alias("gram"))


def counted(urls: DataFrame, *, url: str = "url", accepted: str = "accepted") -> DataFrame:
    """``url, yes, no``: each distinct URL once, with the number of rows that are accepted and rejected. Null ones are empty."""
    told = lambda kind: F.count_if(name_in(urls, accepted) == kind)
    return urls.groupBy(F.coalesce(name_in(urls, url), F.lit("")).alias("url")).agg(told(True).alias("yes"), told(False).alias("no"))


def fit(urls: DataFrame) -> DataFrame:
    """``gram, ratio`` of ``counted`` URLs: the log-likelihood ratio of each character after the four before it, accepted against rejected.

    Each side is a variable-order Markov model: a character after four others is as likely
    as counted there, smoothed (Witten and Bell) by what follows the last three of them, and so on down to
    how often it occurs at all, and that by all characters of the table alike. So a context
    one side has never seen falls back on the shorter one. Counts are sums over all URLs, added up before
    they are shuffled; from then on the table has a row for each distinct gram. URLs that are neither accepted nor rejected
    bring their grams and no counts, so every gram of the URLs given has its ratio.
    """
    spelled = _grams(urls, "yes", "no").groupBy("gram").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    spelled = saved(spelled, "grams")
    chances = None
    for k in range(1, ORDER + 1):
        level = spelled.groupBy(F.right("gram", F.lit(k)).alias("gram")).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        # Those that follow one context: as many as there are characters, at most.
        context = Window.partitionBy(F.left("gram", F.lit(k - 1)))
        level = level.select("gram", *[c.alias(f"{name}_{side}") for side in ("yes", "no") for name, c in (
            ("n", F.col(side)), ("total", F.sum(side).over(context)), ("kinds", F.count_if(F.col(side) > 0).over(context)))],
            F.count(F.lit(1)).over(context).alias("alphabet"))
        if chances is None:
            level = level.withColumns({"p_yes": 1 / F.col("alphabet"), "p_no": 1 / F.col("alphabet")})
        else:
            level = level.withColumn("shorter", F.right("gram", F.lit(k - 1))).join(chances.withColumnRenamed("gram", "shorter"), "shorter")
        chances = level.select("gram", *[_smoothed(side).alias(f"p_{side}") for side in ("yes", "no")])
    return saved(chances.select("gram", (F.log("p_yes") - F.log("p_no")).alias("ratio")), "ratios")


def _smoothed(side: str) -> Column:
    n, total, kinds, p = (F.col(f"{name}_{side}") for name in ("n", "total", "kinds", "p"))
    return F.when(total > 0, (n + kinds * p) / (total + kinds)).otherwise(p)


def score(urls: DataFrame, ratios: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``url, score`` of each of the URLs that ``ratios`` was made from: its log-likelihood ratio for each character and the end.

    Ratios are broadcast where they are at most ``most_broadcast``.
    """
    spelled = _grams(urls, "url")
    if ratios.count() <= most_broadcast:
        found = spelled.join(F.broadcast(ratios), "gram")
    else:
        salted = ratios.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = spelled.withColumn("salt", F.pmod(F.hash("url"), F.lit(SALTS))).join(salted, ["gram", "salt"])
    return found.groupBy("url").agg(F.avg("ratio").alias("score"))


def filter_urls(pages: DataFrame, rules: dict[str, str], *, url: str = "url") -> DataFrame:
    """Pages with ``host``, ``path``, ``rule``, ``score`` and ``verdict`` (allow or block).

    Where a rule fits, it decides; all other URLs are judged by two models of the URLs
    that rules accept and reject. The threshold is calibrated on those: it lies
    between the mean scores of both kinds, as many standard deviations from one as from the other.

    Without URLs of both kinds there is no ratio: every URL without a rule is allowed. A null
    URL has empty host and path, null score and, having no character to speak against it, is allowed.
    Input columns named like results are replaced; a URL column named like one is refused. No pages give none.
    """
    refuse(url, RESULTS)
    pages = without(pages, RESULTS)
    key = name_in(pages, url)
    judged = pages.select("*", host_of(key).alias("host"), path_of(key).alias("path")).withColumn(
        "rule", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for r, v in rules.items()])
    kinds = judged.select(key.alias("url"), (by_rule == "allow").alias("accepted"))
    distinct = saved(counted(kinds.where("url is not null")), "urls")
    scores = saved(score(distinct, fit(distinct)), "scores")
    sides = kinds.where("accepted is not null").join(scores, "url").groupBy("accepted").agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("sd"))
    found = {r["accepted"]: r for r in sides.collect()}  # two rows at most
    limit = float("-inf")
    if len(found) == 2:
        (a, s), (b, t) = [(found[k]["mean"], found[k]["sd"] + 1e-9) for k in (True, False)]
        limit = (a * t + b * s) / (s + t)
    method = F.when(F.coalesce(F.col("score"), F.lit(0.0)) >= limit, "allow").otherwise("block")
    method = F.when(key.isNull(), "allow").otherwise(method)
    scored = judged.join(scores.withColumnRenamed("url", "__url"), key == F.col("__url"), "left").drop("__url")
    return scored.withColumn("verdict", F.coalesce(by_rule, method))
