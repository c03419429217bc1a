"""URL filter: domain rules first, then logistic regression on hashed character n-grams of host and path.

Only DataFrame operations: n-grams are cut and hashed by SQL functions, the model is fitted by the DataFrame-based
logistic regression on a small labelled table, and scoring is a sum over a literal array of weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bodega.llm import common

#: Buckets of the feature hash, and so the length of the weight array.
BUCKETS = 1024
GRAMS = (2, 3, 4)
REGULARISATION = 0.0003

# The labelled table: (url, 1 to block). Invented addresses that show what either kind looks like; languages, numbers and endings
# of paths are dealt alike to both, so that only names tell.
LABELLED = """
0 http://www.riverton.example.com/fr/12
0 https://ashford.example.com/en/734#top
0 https://blog.library.example.net/de/6?page=2&ref=x
0 http://m.docs.example.net/en/153/
0 https://www.news.example.org/es/92?utm_source=feed
0 https://university.example.org/fr/2096?page=2
0 http://blog.museum.example.com/en/323.html
0 https://m.recipes.example.com/de/19
0 https://www.forum.example.net/en/741#top
0 http://weather.example.net/es/13?page=2&ref=x
0 https://blog.journal.example.org/fr/160/
0 https://m.lorant.example.org/en/99?utm_source=feed
0 http://www.shenwick.example.com/de/2103?page=2
0 https://morthal.example.com/en/330.html
0 https://blog.stennis.example.net/es/26
0 http://m.bretton.example.net/fr/748#top
0 https://www.hathenby.example.org/en/20?page=2&ref=x
0 https://intore.example.org/de/167/
0 http://blog.wesley.example.com/en/106?utm_source=feed
0 https://m.carding.example.com/es/2110?page=2
0 https://www.northam.example.net/fr/337.html
0 http://oakworth.example.net/en/33
0 https://blog.melrose.example.org/de/755#top
0 https://m.tanner.example.org/en/27?page=2&ref=x
0 http://www.bexhill.example.com/es/174/
0 https://sandling.example.com/fr/113?utm_source=feed
0 https://blog.corbridge.example.net/en/2117?page=2
0 http://m.ellerton.example.net/de/344.html
0 https://www.thornby.example.org/en/40
0 https://tilsham.example.org/es/762#top
0 http://blog.storth.example.com/fr/34?page=2&ref=x
0 https://m.sharrow.example.com/en/181/
0 https://www.tenbury.example.net/de/120?utm_source=feed
0 http://thames.example.net/en/2124?page=2
0 https://blog.theatre.example.org/es/351.html
0 https://m.shelby.example.org/fr/47
0 http://www.tithe.example.com/en/769#top
0 https://tolson.example.com/de/41?page=2&ref=x
0 https://blog.stonehouse.example.net/en/188/
0 http://m.thistle.example.net/es/127?utm_source=feed
0 https://www.throne.example.org/fr/2131?page=2
0 https://tiller.example.org/en/358.html
0 http://blog.sheringham.example.com/de/54
0 https://m.station.example.com/en/776#top
0 https://www.nations.example.net/es/48?page=2&ref=x
0 http://thirsk.example.net/fr/195/
0 https://blog.orchard.example.org/en/134?utm_source=feed
0 https://m.hedger.example.org/de/2138?page=2
0 http://www.thetford.example.com/en/365.html
0 https://winter.example.com/es/61
0 https://blog.dandelion.example.net/fr/783#top
0 http://m.streatham.example.net/en/55?page=2&ref=x
0 https://www.ander.example.org/de/202/
0 https://ention.example.org/en/141?utm_source=feed
0 http://blog.sthone.example.com/es/2145?page=2
1 http://www.pills-money.example.com/fr/12
1 https://casino-loan.example.com/en/734#top
1 https://blog.bets-adult.example.net/de/6?page=2&ref=x
1 http://m.spam-xxx.example.net/en/153/
1 https://www.cheap-cams.example.org/es/92?utm_source=feed
1 https://free-prize.example.org/fr/2096?page=2
1 http://blog.win-links.example.com/en/323.html
1 https://m.money-seo.example.com/de/19
1 https://www.loan-replica.example.net/en/741#top
1 http://adult-watches.example.net/es/13?page=2&ref=x
1 https://blog.xxx-payday.example.org/fr/160/
1 https://m.cams-cash.example.org/en/99?utm_source=feed
1 http://www.prize-hot.example.com/de/2103?page=2
1 https://links-singles.example.com/en/330.html
1 https://blog.seo-crack.example.net/es/26
1 http://m.replica-serials.example.net/fr/748#top
1 https://www.watches-track.example.org/en/20?page=2&ref=x
1 https://payday-clicks.example.org/de/167/
1 http://blog.cash-ads.example.com/en/106?utm_source=feed
1 https://m.hot-bonus.example.com/es/2110?page=2
1 https://www.singles-farm.example.net/fr/337.html
1 http://crack-pill.example.net/en/33
1 https://blog.serials-bet.example.org/de/755#top
1 https://m.track-pills.example.org/en/27?page=2&ref=x
1 http://www.clicks-casino.example.com/es/174/
1 https://ads-bets.example.com/fr/113?utm_source=feed
1 https://blog.bonus-spam.example.net/en/2117?page=2
1 http://m.farm-cheap.example.net/de/344.html
1 https://www.pill-free.example.org/en/40
1 https://bet-win.example.org/es/762#top
1 http://blog.pills-cams.example.com/fr/34?page=2&ref=x
1 https://m.casino-prize.example.com/en/181/
1 https://www.bets-links.example.net/de/120?utm_source=feed
1 http://spam-seo.example.net/en/2124?page=2
1 https://blog.cheap-replica.example.org/es/351.html
1 https://m.free-watches.example.org/fr/47
1 http://www.win-payday.example.com/en/769#top
1 https://money-cash.example.com/de/41?page=2&ref=x
1 https://blog.loan-hot.example.net/en/188/
1 http://m.adult-singles.example.net/es/127?utm_source=feed
1 https://www.xxx-crack.example.org/fr/2131?page=2
1 https://cams-serials.example.org/en/358.html
1 http://blog.prize-track.example.com/de/54
1 https://m.links-clicks.example.com/en/776#top
1 https://www.seo-ads.example.net/es/48?page=2&ref=x
1 http://replica-bonus.example.net/fr/195/
1 https://blog.watches-farm.example.org/en/134?utm_source=feed
1 https://m.payday-pill.example.org/de/2138?page=2
1 http://www.cash-bet.example.com/en/365.html
1 https://hot-pills.example.com/es/61
1 https://blog.singles-casino.example.net/fr/783#top
1 http://m.crack-bets.example.net/en/55?page=2&ref=x
1 https://www.serials-spam.example.org/de/202/
1 https://track-cheap.example.org/en/141?utm_source=feed
1 http://blog.clicks-free.example.com/es/2145?page=2
1 https://m.ads-win.example.com/fr/372.html
1 https://www.bonus-money.example.net/en/68
1 http://farm-loan.example.net/de/790#top
1 https://blog.pill-adult.example.org/en/62?page=2&ref=x
1 https://m.bet-xxx.example.org/es/209/
"""

#: (host, path, verdict); a rule fits its host and all subdomains where the path starts with the rule's.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null and without ://."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1), upper, lower)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def buckets(text: Column, kind: str, sizes: tuple[int, ...] = GRAMS) -> Column:
    """The feature buckets of a text's character n-grams, with its ends marked; repeats included."""
    letters = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")

    def grams(n: int) -> Column:
        # Shifted copies side by side, so that a gram is one element and the text is cut once per copy.
        rows = F.arrays_zip(*[F.slice(letters, k + 1, F.size(letters)).alias(f"c{k}") for k in range(n)])
        whole = F.filter(rows, lambda z: z[f"c{n - 1}"].isNotNull())
        return F.transform(whole, lambda z: F.pmod(F.xxhash64(F.lit(kind), *[z[f"c{k}"] for k in range(n)]), F.lit(BUCKETS)).cast("int"))

    return F.concat(*[grams(n) for n in sizes])


def labelled_urls(spark: SparkSession, lines: str = LABELLED) -> DataFrame:
    values = ", ".join(f"({a}.0D, '{b}')" for a, b in (line.split() for line in lines.split("\n") if line))
    return spark.sql(f"select * from values {values} as t(label, url)")


def fit(labelled: DataFrame) -> tuple[float, list[float]]:
    """Intercept and one weight per bucket from (label 1 to block, url). A handful of rows is enough.

    A feature is how many of the host's and the path's n-grams fall in the bucket, each over the root of their number. Rows without a label or URL
    are left out; without rows of both labels every URL is allowed.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    rows = labelled.filter("label is not null and url is not null").select("label", "url")
    if rows.select("label").distinct().count() < 2:
        return -1.0, [0.0] * BUCKETS

    def shares(found: Column) -> Column:
        each = F.lit(1.0) / F.sqrt(F.size(found))
        return F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda k: F.size(F.filter(found, lambda b: b == k)) * each)

    parts = rows.select("label", buckets(host_of(F.col("url")), "host").alias("h"), buckets(path_of(F.col("url")), "path").alias("p"))
    both = F.zip_with(shares(F.col("h")), shares(F.col("p")), lambda a, b: a + b)
    table = common.settle(parts.select("label", both.alias("x")).coalesce(1), "labelled-urls").select("label", array_to_vector("x").alias("features"))
    model = LogisticRegression(regParam=REGULARISATION, standardization=False, maxIter=100).fit(table)
    return float(model.intercept), [float(w) for w in model.coefficients]


def margin(host: Column, path: Column, model: tuple[float, list[float]]) -> Column:
    intercept, weights = model
    held = F.lit(weights)

    def part(found: Column) -> Column:
        return F.aggregate(found, F.lit(0.0), lambda s, b: s + F.get(held, b)) / F.sqrt(F.size(found))

    return F.lit(intercept) + part(buckets(host, "host")) + part(buckets(path, "path"))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does. Equal length: first in the list."""
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    cases = [
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
               F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
        for h, p, verdict in ordered
    ]
    return F.coalesce(*cases, F.lit(None).cast("struct<rule:string,verdict:string>"))


def filter_urls(pages: DataFrame, labelled: DataFrame | None = None, rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, block_score (the model's probability that the URL is to be blocked).

    A URL no rule fits is blocked if its score is at least 0.5. Null URLs and ones without :// have empty host and path
    and are scored as such. Repeated rows are kept; columns other than page_id and url are ignored.
    """
    model = fit(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(F.col("host"), F.col("path"), model)))
    own = matched_rule(F.col("host"), F.col("path"), RULES if rules is None else rules)
    scored = cut.withColumn("_rule", own).withColumn("block_score", score)
    by_method = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"),
                         F.coalesce(F.col("_rule.verdict"), by_method).alias("verdict"), "block_score")
