"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

The regression is fitted by Spark's own trainer on a small labelled table of URLs; scoring is a projection
that looks the n-grams' buckets up in the fitted weights. Defined results: a null URL, or one without
`://`, has an empty host and path, fits no rule and has no n-grams, so that the intercept decides (allow).
Repeated rows are judged each on its own; extra columns pass through `judged` in the struct `row`.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewell.llm.common import constants

BUCKETS = 8192
SIZES = (3, 4, 5)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# (verdict, host, path) of production runs: a rule fits its host and all subdomains.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

# Labelled by hand: invented addresses, each with the kind of words such sites carry.
BLOCKED = """
casino-royal.example.com/en/12 best-casino.example.org/win/4 casino-slots.example.com/play win-big.example.com/casino/7
online-casino.example.org/es/3 jackpot-win.example.com/en/99 free-spins.example.org/bonus slots-win.example.com/de/8
free-casino.example.com/fr/5 poker-bets.example.org/en/1 sports-bets.example.com/odds free-betting.example.org/en/31
bets-online.example.com/en/6 live-bets.example.org/fr/2 free-bets-now.example.com/es/11 betting-tips.example.org/win
cheap-meds.example.com/en/77 pills-online.example.org/buy cheap-viagra.example.com/pills/3 discount-pills.example.com/es/2
buy-pills.example.org/en/40 cheap-pharmacy.example.com/fr/6 diet-pills.example.com/en/5 cheap-loans.example.org/en/8
ads-server.example.com/track/1 ad-track.example.org/click/5 click-track.example.com/ads/9 ads-network.example.org/en/3
track-ads.example.com/fr/17 popup-ads.example.org/en/64 adserver-track.example.com/en/2 tracking-ads.example.org/de/4
spam-links.example.com/en/9 link-farm.example.org/en/70 spam-blog.example.com/fr/8 content-farm.example.org/es/5
seo-spam.example.com/en/13 farm-spam.example.org/en/28 spam-seo.example.com/link-farm/1 linkfarm.example.org/fr/66
adult-video.example.com/en/18 xxx-adult.example.org/en/5 adult-chat.example.com/fr/3 adult-xxx.example.org/es/1
free-adult.example.com/en/21 porn-adult.example.org/en/80 adult-dating.example.com/de/9 sex-chat.example.org/en/2
adult-x-video.example.com/en/3 adult-x-rated.example.org/fr/8 xadult.example.com/en/4 my-adult-x.example.org/es/55
ads-track-pixel.example.com/en/6 web-ads-track.example.org/fr/1 casino-winner.example.com/en/3 spam-farms.example.org/en/2
""".split()
ALLOWED = """
www.example.com/ www.example.org/ www.example.net/ news.example.com/en/2024/05/story.html city-news.example.org/fr/12
daily.example.com/es/88 weather.example.org/en/7 maps.example.com/en/415 library.example.org/en/books/12
museum.example.com/fr/visit archive.example.org/en/1999/ history.example.com/de/3 science.example.org/en/journal/44
physics.example.com/en/paper/3 math.example.org/fr/cours/1 school.example.com/en/class.html university.example.org/es/9
docs.example.com/en/manual/install.html wiki.example.org/en/page/771 blog.example.com/en/17 m.example.org/en/904
blog.garden.example.com/fr/80 m.cooking.example.org/es/10 recipes.example.com/en/soup.html kitchen.example.org/fr/77
travel.example.com/en/rome/5 hotel.example.org/es/12 train.example.com/de/fahrplan bus.example.org/en/route/8
health.example.com/en/advice/2 hospital.example.org/fr/8 doctor.example.com/es/41 clinic.example.org/en/6
music.example.com/en/album/9 radio.example.org/fr/live film.example.com/es/77 theatre.example.org/en/20
book-club.example.com/en/3 chess-club.example.org/en/41 bird-watch.example.com/en/5 open-data.example.org/fr/31
farm-shop.example.com/en/8 free-software.example.org/en/9 track-field.example.com/es/2 winter.example.org/en/14
code.example.com/en/project/1 data.example.org/en/set/55 forum.example.com/fr/topic/8 help.example.org/es/faq
shop.example.com/en/basket store.example.org/fr/27 market.example.com/es/90 bank.example.org/en/branch/4
law.example.com/en/act/3 court.example.org/fr/4 council.example.com/en/65 parliament.example.org/es/7
the.example.com/en/1 and.example.org/fr/2 thering.example.com/en/550 anders.example.org/en/612 shore.example.com/fr/70
nether.example.org/en/302 eastern.example.com/es/820 heather.example.org/en/45 other.example.com/en/91?page=2
ester.example.com/en/633.html onion.example.org/en/28#top station.example.com/fr/47 orient.example.org/es/503
thistle.example.com/en/719 reader.example.org/en/356/ nation.example.com/fr/274 listen.example.org/en/18
weston.example.com/es/408 harbor.example.org/en/960 tundra.example.com/fr/131 outer.example.org/en/845
that.example.com/en/14 thatcher.example.org/fr/52 hathaway.example.com/es/6 threads.example.org/en/381
""".split()


def parts(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    name = verdict = None
    for what, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path) if name is None else name.when(fits, rule_host + rule_path)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    if name is None:
        name = verdict = F.lit(None).cast("string")
    return name, verdict


def buckets(host: Column, path: Column) -> Column:
    """Buckets of the distinct n-grams of host and path, ends marked; each side has n-grams of its own."""
    def grams(s: Column, side: str, n: int) -> Column:
        marked = F.concat(F.lit("^"), s, F.lit("$"))
        return F.when((F.length(s) > 0) & (F.length(marked) >= n), F.transform(
            F.sequence(F.lit(1), F.length(marked) - (n - 1)),
            lambda i: F.concat(F.lit(side), F.substring(marked, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))

    every = F.concat(*[grams(s, side, n) for s, side in ((host, "h"), (path, "p")) for n in SIZES])
    return F.array_distinct(F.transform(every, lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int")))


def labelled(spark: SparkSession) -> DataFrame:
    """The small labelled table: url, label (1: block)."""
    rows = [{"url": "http://" + u, "label": float(k)} for k, urls in ((1, BLOCKED), (0, ALLOWED)) for u in urls]
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), "array<struct<url:string,label:double>>")))


def fit(examples: DataFrame, strength: float = 0.002) -> tuple[list[float], float]:
    """Weights by bucket and the intercept. `examples` (url, label) is small by contract: it is brought
    into one partition, so that sums are always added in the same order."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    host, path = parts(F.col("url"))
    # the one-element array computes a row's buckets once, not once for each place of the vector
    dense = F.get(F.transform(F.array(buckets(host, path)), lambda b: F.transform(
        F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda i: F.array_contains(b, i).cast("double"))), F.lit(0))
    rows = examples.coalesce(1).select("label", array_to_vector(dense).alias("features"))
    model = LogisticRegression(regParam=strength, maxIter=60, standardization=False).fit(rows)
    return [round(float(w), 6) for w in model.coefficients], round(float(model.intercept), 6)


def probability(host: Column, path: Column, model: tuple[list[float], float]) -> Column:
    """That the URL should be blocked."""
    weights = constants(model[0])
    logit = F.aggregate(buckets(host, path), F.lit(model[1]), lambda total, b: total + F.get(weights, b))
    return 1 / (1 + F.exp(-logit))


def judged(pages: DataFrame, model: tuple[list[float], float], rules=RULES, threshold: float = 0.5) -> DataFrame:
    """row (all columns of pages), host, path, rule, score, verdict."""
    host, path = parts(F.col("row.url"))
    split = pages.select(F.struct("*").alias("row")).select("row", host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    return split.select("row", "host", "path", rule.alias("rule"), verdict.alias("_v"),
                        probability(F.col("host"), F.col("path"), model).alias("score")).select(
        "row", "host", "path", "rule", "score",
        F.coalesce("_v", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"))


def query(pages: DataFrame) -> DataFrame:
    model = fit(labelled(pages.sparkSession))
    return judged(pages.select("page_id", "url"), model).select(
        "row.page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))
