"""URL filter by character language models.

Two smoothed variable-order Markov models, one of accepted and one of rejected URLs, give every
character of a URL's host and path a log-likelihood ratio.  Its mean over the URL, length
normalised, is compared with a threshold calibrated on the labelled URLs.  URLs that a rule
decides are the labelled ones: allowed rows train the accepted model, blocked rows the other.

A character's probability after a context of ``k`` characters is
``(n(context, char) + strength * p(k-1)) / (n(context) + strength)``, from no context up to
``order`` characters.  Counts cover every labelled URL.

Scale: counts are combined per distinct n-gram in the map tasks, all smoothing runs over distinct
n-grams, and a context has at most one row per character of the alphabet, so no group grows with
the input.  Ratios are rounded to 1e-6 and summed as integers: reruns agree bit for bit.  Characters
of the URLs meet their ratios in an equi-join whose large side may be split by Spark.

Defined results: a null URL or one without ``://`` has an empty host and path and is judged by the
models like any other; with no labelled URL of one kind the threshold is 0; repeated rows
are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indexforge.llm.text import let, lower_az, stored

#: Fixed values: (verdict, host, path) of the rules.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
START, END = "\x02", "\x03"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) after the first ``://``; both empty without one."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (lower_az(F.regexp_extract(rest, "^[^/?#]*", 0)),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else nulls."""
    name = verdict = None
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return name, verdict


def _grams(text: Column, order: int) -> Column:
    """Every character with the ``order`` characters before it; digits count as one character."""
    s = F.concat(F.lit(START * order), F.regexp_replace(F.lower(text), "[0-9]", "0"), F.lit(END))
    return let(F.split(s, ""), lambda c: F.transform(
        F.slice(c, F.lit(1), F.size(c) - order),
        lambda x, i: F.concat(x, *[F.get(c, i + k) for k in range(1, order + 1)])))


def fit_ratio(labelled: DataFrame, text: str, accepted: str, order: int = 4,
              strength: float = 2.0) -> DataFrame:
    """(gram, micro): 1e6 x the log ratio of the two models for each n-gram of ``labelled``.

    ``accepted`` is true, false, or null for a URL that is only scored.
    """
    rows = labelled.select(F.col(accepted).alias("y"), F.explode(_grams(F.col(text), order)).alias("gram"))
    grams = stored(rows.groupBy("gram").agg(F.count_if("y").alias("a"),
                                            F.count_if(~F.col("y")).alias("r")), "url_grams")
    prob = None
    for k in range(order + 1):
        g = grams.groupBy(F.substring("gram", order + 1 - k, k + 1).alias("g")).agg(
            F.sum("a").alias("a"), F.sum("r").alias("r"))
        w = Window.partitionBy(F.substring("g", 1, k))
        g = g.select("g", "a", "r", F.sum("a").over(w).alias("ca"), F.sum("r").over(w).alias("cr"))
        if prob is None:
            g = g.withColumn("pa", F.lit(1 / 256)).withColumn("pr", F.lit(1 / 256))
        else:
            g = g.join(prob, F.substring("g", 2, k) == F.col("s"))
        prob = g.select(F.col("g").alias("s"),
                        ((F.col("a") + strength * F.col("pa")) / (F.col("ca") + strength)).alias("pa"),
                        ((F.col("r") + strength * F.col("pr")) / (F.col("cr") + strength)).alias("pr"))
    return stored(prob.select(F.col("s").alias("gram"), F.round(
        F.log(F.col("pa") / F.col("pr")) * 1e6).cast("long").alias("micro")), "url_model")


def score_urls(urls: DataFrame, text: str, model: DataFrame, order: int = 4) -> DataFrame:
    """(k1, k2, score): the mean ratio of each distinct text, named by two hashes."""
    one = urls.select(F.col(text).alias("t")).distinct()
    rows = one.select(F.xxhash64("t").alias("k1"), F.crc32("t").alias("k2"),
                      F.explode(_grams(F.col("t"), order)).alias("gram"))
    return rows.join(model, "gram").groupBy("k1", "k2").agg(
        (F.sum("micro") / F.count(F.lit(1)) / 1e6).alias("score"))


def calibrated(scores: DataFrame, step: float = 0.01) -> float:
    """The cut, in steps, with the best balanced accuracy on (score, y).

    Scores lie within +-log(256) per character and more, so the histogram has at most a few
    thousand rows at any size of the table; only that comes to the driver.
    """
    bins = sorted((r["b"], r["a"], r["r"]) for r in scores.groupBy(
        F.floor(F.col("score") / step).alias("b")).agg(
            F.count_if("y").alias("a"), F.count_if(~F.col("y")).alias("r")).collect())
    na, nr = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not na or not nr:
        return 0.0
    best, cut, a, r = -1.0, 0.0, 0, 0
    for i, (b, x, y) in enumerate(bins):  # below the cut: rejected
        if r / nr + (na - a) / na > best:
            # half way between this bin and the one before it
            best = r / nr + (na - a) / na
            cut = (b + (bins[i - 1][0] + 1 if i else b)) / 2 * step
        a, r = a + x, r + y
    if r / nr + (na - a) / na > best:
        cut = (bins[-1][0] + 1) * step
    return cut if math.isfinite(cut) else 0.0


def filter_urls(pages: DataFrame, key: str = "page_id", url: str = "url", *, rules=RULES,
                order: int = 4, strength: float = 2.0) -> DataFrame:
    """One row per row of ``pages``: key, host, path, rule, verdict and the models' score."""
    host, path = url_parts(F.col("url"))
    p = pages.select(F.col(key).alias("key"), F.col(url).alias("url")).select(
        "key", host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    p = stored(p.select("key", "host", "path", name.alias("rule"), verdict.alias("decided"),
                        F.concat("host", "path").alias("t")), "url_parts")
    p = p.withColumn("y", F.col("decided") == "allow")
    model = fit_ratio(p, "t", "y", order, strength)
    scores = stored(score_urls(p, "t", model, order), "url_scores")
    scored = p.withColumns({"h1": F.xxhash64("t"), "h2": F.crc32("t")}).join(
        scores, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")))
    cut = calibrated(scored.filter("y is not null").select("score", "y"))
    return scored.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce(
        "decided", F.when(F.col("score") >= cut, "allow").otherwise("block")).alias("verdict"), "score")
