"""URL filters: logistic regression on hashed character n-grams of host and path, in DataFrame operations only.

The model learns from a small table of labelled URLs (``LABELLED`` by default, ``MAX_LABELLED`` rows at
most): full gradient steps, each one aggregation over (url, n-gram), until ``STEPS``. The weights, one for
each of ``DIMENSIONS`` coordinates, go into the scoring expression as an array. Rules for hosts and paths
come first: the longest that fits decides, and the model judges the rest.

A null url, or one without ``://``, has empty host and path; no rule fits it and the model sees no n-gram,
so the intercept decides. Repeated rows are judged alike.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scfsweep.llm.common import table

DIMENSIONS = 1 << 12
SIZES = (3, 4, 5)
STEPS = 40
RATE, L2 = 4.0, 1e-3
MAX_LABELLED = 10_000
MAX_RULES = 1_000

#: verdict, host, path
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: Words of hosts to block, and of hosts to let pass; with the patterns below they are the labelled table.
#: General vocabulary of junk and of ordinary sites, not taken from any table of pages; hyphens are
#: about as frequent on either side. See the README.
BLOCKED = tuple(
    """
    online-casino jackpot roulette slotmachines poker blackjack betting wagers lottery sweepstakes prizes giveaway dietpills discountpills
    viagra cialis rx-meds cheap-meds weightloss replica-watches fakerolex paydayloans quickloans easy-credit debtrelief get-rich
    earncash winmoney cryptodoubler xxx porn sexcams escorts hookup nudes camgirls hotsingles warez keygen crackedgames serialz
    popunder adserver bannerclicks pixel-tracker backlinks buyfollowers bulk-mail massmailer spyware malware phishinglogin
    verify-account miracle-cure forex-signals pyramidscheme
    """.split()
)
ALLOWED = tuple(
    """
    library garden news weather museum school travel history science cooking recipes music theatre orchestra cathedral hospital dentist
    bakery bookshop publishing journal research physics chemistry biology mathematics engineering software database astronomy geography
    atlas railway transport airport harbour sailing cycling football tennis chess knitting pottery painting gallery photography
    architecture furniture carpentry plumbing insurance accounting lawyer government parliament council police charity church community
    children parents kindergarten teacher dictionary encyclopedia language translation poetry literature philosophy psychology economics
    politics energy forest mountain river wildlife birds horses veterinary restaurant hotel coffee cheese fashion jewellery toys
    town-hall book-club night-school science-museum film-festival art-history open-source second-hand local-news bird-watching high-school
    folk-music bus-timetable tax-office post-office swimming-pool city-council sports-club youth-hostel family-doctor
    """.split()
)
PATTERNS = (
    "http://{}.com/", "https://www.{}.org/index.html", "https://{}.info/about/contact", "http://shop.{}.biz/item?id=4", "https://{}.co.uk/articles/2019/05/welcome",
    "http://my-{}.net/page.php", "https://the{}.eu/", "http://{}24.us/home/start.htm", "https://city{}.io/docs/",
)
LABELLED = tuple((p.format(w), y) for y, words in ((1, BLOCKED), (0, ALLOWED)) for w in words for p in PATTERNS)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(urls: DataFrame) -> DataFrame:
    """urls with host and path, cut from the column url."""
    rest = F.expr("if(instr(url, '://') > 0, substr(url, instr(url, '://') + 3), '')")
    return (
        urls.withColumn("__rest", F.coalesce(rest, F.lit("")))
        .withColumn("host", F.translate(F.regexp_extract("__rest", r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER))
        .withColumn("path", F.regexp_extract("__rest", r"(?s)^[^/?#]*([^?#]*)", 1))
        .drop("__rest")
    )


def coordinates() -> F.Column:
    """Hashed n-grams of ``host path`` with a mark at either end, each once; none where both are empty."""
    marked = "concat('^', host, ' ', path, '$')"
    grams = ", ".join(f"transform(sequence(1, greatest(length(s) - {n - 1}, 1)), i -> substr(s, i, {n}))" for n in SIZES)
    made = f"array_distinct(transform(concat({grams}), g -> cast(pmod(xxhash64(g), {DIMENSIONS}) as int)))"
    return F.expr(f"if(host = '' and path = '', cast(array() as array<int>), transform(array({marked}), s -> {made})[0])")


def _logit(weights: list[float]) -> F.Column:
    w = F.from_json(F.lit(json.dumps(weights[:-1])), "array<double>")
    return F.aggregate("at", F.lit(float(weights[-1])), lambda s, i: s + F.element_at(w, i + 1))


def train(spark: SparkSession, labelled: DataFrame, steps: int = STEPS) -> list[float]:
    """DIMENSIONS weights and the intercept from labelled(url, label), a small table; label 1 is to block."""
    rows = host_and_path(labelled.filter("label is not null").limit(MAX_LABELLED)).select(coordinates().alias("at"), F.col("label").cast("double").alias("label")).cache()
    n = rows.count()
    weights = [0.0] * (DIMENSIONS + 1)
    for step in range(steps if n else 0):
        miss = rows.select("at", (F.lit(1.0) / (1 + F.exp(-_logit(weights))) - F.col("label")).alias("miss"))
        # coordinate -1 is the intercept; a url's n-grams share one step, whatever their number
        each = miss.select("miss", F.explode(F.array_append("at", F.lit(-1))).alias("k"))
        for r in each.groupBy("k").agg(F.sum("miss").alias("g")).collect():  # DIMENSIONS + 1 rows at most
            weights[r.k] -= RATE / n * (r.g if r.k >= 0 else r.g / 4)
        weights[:-1] = [w * (1 - RATE * L2) for w in weights[:-1]]
    rows.unpersist()
    return weights


def judge(spark: SparkSession, urls: DataFrame, weights: list[float], rules: tuple = RULES) -> DataFrame:
    """urls with host, path, rule, verdict and the model's score."""
    if len(rules) > MAX_RULES:
        raise ValueError("too many rules to test one by one; join the hosts' suffixes with a table of rules instead")
    kind = "array<struct<verdict: string, host: string, path: string>>"
    given = F.from_json(F.lit(json.dumps([{"verdict": v, "host": h, "path": p} for v, h, p in rules])), kind)
    fits = lambda r: ((F.col("host") == r["host"]) | F.col("host").endswith(F.concat(F.lit("."), r["host"]))) & F.startswith(F.col("path"), r["path"])
    ranked = F.transform(F.filter(given, fits), lambda r: F.struct(F.length(r["host"]) + F.length(r["path"]), F.concat(r["host"], r["path"]).alias("rule"), r["verdict"].alias("verdict")))
    best = host_and_path(urls).withColumn("__best", F.array_max(ranked)).withColumn("at", coordinates())
    scored = best.withColumn("score", 1 / (1 + F.exp(-_logit(weights))))
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.withColumn("rule", F.col("__best.rule")).withColumn("verdict", F.coalesce("__best.verdict", own)).drop("__best", "at")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The default labelled table."""
    rows = F.from_json(F.lit(json.dumps([{"url": u, "label": y} for u, y in LABELLED])), "array<struct<url: string, label: int>>")
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(spark, pages, train(spark, labelled_urls(spark))).select("page_id", "host", "path", "rule", "verdict", "score")
