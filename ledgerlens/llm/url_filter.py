"""URL filters: policy rules, then a logistic regression over hashed n-grams.

Native: DataFrame and SQL functions only.  The features of a URL are the
distinct character n-grams of its host and path, hashed into ``DIM`` places.
The regression is trained inside one query from a small labelled URL table:
gradient descent on ``n`` coefficients, one per labelled URL (the weights of
any L2-penalised gradient descent from zero are a combination of the training
rows), turned into one weight per place at the end.

Bounds: the labelled table is a parameter of at most ``MAX_LABELLED`` rows;
the model is one array of ``DIM`` numbers, read by a scalar subquery.

Cases: a null URL or one without ``://`` has empty host and path, no features
and so the verdict of the intercept; only A-Z are lower-cased; a repeated URL
gets equal rows; labels other than ``allow`` and ``block`` and null URLs in
the labelled table teach nothing; with no labelled row the verdict is allow;
other columns are ignored; a very long URL is read in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import pin

DIM = 1 << 14
SIZES = (3, 4, 5)
STEPS = 600
RATE, DECAY = 8.0, 0.001
MAX_LABELLED = 400
BLOCK_AT = 0.7      # a block needs evidence: an unknown host lies near one half

# The policy of the registered query, host/path and verdict.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))

# Names of the labelled hosts (a stand-in for a reviewed list).
BLOCKED = ("casino-royal", "best-casino", "win-jackpot", "free-bets", "sport-bets", "cheap-pills", "pills-online",
           "ads-track", "track-ads", "poker-win", "casino-slots", "cheap-meds", "win-casino", "bets-now",
           "click-ads", "fast-loans", "replica-cheap", "spam-offers", "link-farm", "free-prize", "pills-shop",
           "casino-win", "bonus-bets", "adult-videos")
ALLOWED = ("library", "daily-news", "garden", "weather", "university", "python-docs", "recipes", "museum", "history",
           "travel", "theatre", "science", "council", "music", "schools", "astronomy", "nature", "the-times",
           "other-things", "northern", "winter-sports", "station", "therapy", "freedom")
PREFIXES = ("", "www.", "m.", "blog.")
PATHS = ("/en/1", "/fr/2204", "/de/31.html", "/es/540/", "/en/7617/", "/fr/88.html", "/de/4033", "/es/9")
#: Both verdicts get the same prefixes and paths, so that the names decide.
LABELLED = tuple((f"https://{PREFIXES[i % 4]}{name}.test{PATHS[(i + i // 8) % 8]}", verdict)
                 for names, verdict in ((BLOCKED, "block"), (ALLOWED, "allow")) for i, name in enumerate(names))

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and the path of a URL, both empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), *_LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _grams(text: Column, kind: str) -> Column:
    """Hashed n-grams of all sizes, the text's ends marked."""
    chars = F.filter(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""), lambda c: c != "")

    def of(size):
        last = F.size(chars) - size
        return F.when((last >= 0) & (text != ""), F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.pmod(F.xxhash64(F.lit(kind), *[F.get(chars, i + k) for k in range(size)]), F.lit(DIM)).cast("int")
        )).otherwise(F.array().cast("array<int>"))

    return F.concat(*[of(size) for size in SIZES])


def features(host: Column, path: Column) -> Column:
    return F.array_distinct(F.concat(_grams(host, "h"), _grams(path, "p")))


def train(labelled: DataFrame) -> DataFrame:
    """One row with the weights: ``DIM`` of them, then the intercept."""
    host, path = host_path(F.col("url"))
    rows = (labelled.where("url is not null and label in ('allow', 'block')")
            .select("url", "label").distinct().orderBy("url", "label").limit(MAX_LABELLED)
            .select(F.col("url"), (F.col("label") == "block").cast("double").alias("y"),
                    features(host, path).alias("f")))
    sets = rows.agg(F.sort_array(F.collect_list(F.struct("url", "y", "f"))).alias("x"))
    size = lambda r: F.greatest(F.size(r["f"]), F.lit(1))
    kernel = F.transform("x", lambda a: F.transform("x", lambda b:
                         F.size(F.array_intersect(a["f"], b["f"])) / F.sqrt(size(a) * size(b)) + 1))

    def step(alpha, _):
        def dot(k):
            return F.aggregate(F.zip_with(k, alpha, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

        return F.transform(alpha, lambda a, i: a * (1 - RATE * DECAY)
                           + RATE / F.greatest(F.size("x"), F.lit(1)) * (F.get(F.col("x"), i)["y"]
                                                                         - 1 / (1 + F.exp(-dot(F.get(F.col("k"), i))))))

    # written first: inlined into the steps, the kernel would be computed anew in each
    fitted = pin(sets.withColumn("k", kernel)).select("x", F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)), F.transform("x", lambda r: F.lit(0.0)), step).alias("alpha"))
    fitted = pin(fitted)
    each = fitted.select(F.posexplode("x").alias("i", "r"), "alpha").select(
        F.get("alpha", F.col("i")).alias("a"), "r.f")
    weight = (each.select(F.explode("f").alias("j"), (F.col("a") / F.sqrt(F.size("f"))).alias("w"))
              .union(each.select(F.lit(DIM), F.col("a"))).groupBy("j").agg(F.sum("w").alias("w")))
    places = labelled.sparkSession.range(DIM + 1).select(F.col("id").cast("int").alias("j"))
    return pin(
        places.join(weight, "j", "left")
            .agg(F.sort_array(F.collect_list(F.struct("j", F.coalesce("w", F.lit(0.0)).alias("w")))).alias("w"))
            .select(F.transform("w", lambda r: r["w"]).alias("w")))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits (struct of rule and verdict), else null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def judge(pages: DataFrame, labelled: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the model's probability of block."""
    host, path = host_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    f = F.col("f")
    total = F.aggregate(f, F.lit(0.0), lambda s, j: s + F.get(F.col("w"), j))
    logit = F.get("w", F.lit(DIM)) + total / F.sqrt(F.greatest(F.size(f), F.lit(1)))
    return (rows.withColumn("f", features(F.col("host"), F.col("path"))).withColumn("w", train(labelled).scalar())
            .select("page_id", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("r"),
                    (1 / (1 + F.exp(-logit))).alias("p_block"))
            .select("page_id", "host", "path", "r.rule",
                    F.coalesce("r.verdict", F.when(F.col("p_block") >= BLOCK_AT, "block").otherwise("allow")).alias("verdict"),
                    "p_block"))


def labelled_table(spark: SparkSession, rows=LABELLED) -> DataFrame:
    """The labelled table as a DataFrame of SQL literals."""
    return spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(u).alias("url"), F.lit(v).alias("label")) for u, v in rows])).alias("r")).select("r.*")
