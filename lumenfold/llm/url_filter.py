"""URL filters: domain rules first, then logistic regression on hashed character n-grams of host and path.

Everything that touches pages is a Spark SQL expression. The model is trained in SQL too: the Gram matrix of the small
labelled table comes from a self-join on n-gram buckets, gradient descent on the dual coefficients is one aggregate()
over a single row, and the weights (a fixed number of buckets) are read once and inlined as an array literal.

The table lists ordinary kinds of hosts; none of them comes from the tables that the filter is tested on. Null urls and urls
without "://" have an empty host and an empty path; no rule fits them and the model judges the bias alone.
A tie (probability 0.5) is blocked. Repeated rows each get their own, equal result; empty tables give empty results; other
columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path, verdict)
RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]
#: Hashed n-gram buckets: three hexadecimal digits of md5.
BUCKETS = 4096
STEPS, RATE, DECAY = 300, 2.0, 0.002
#: Labelled urls: 1 is to be blocked.
SPAM_HOSTS = """cheap-pills online-casino free-bets adult-chat payday-loans fake-watches buy-followers win-prizes hot-singles ads-tracker
link-farm spam-farm xxx-cams crypto-double replica-bags diet-pills free-money lottery-winner sexy-dating bonus-casino seo-backlinks
click-tracker banner-ads essay-writers betting-tips viagra-shop""".split()
GOOD_HOSTS = """library museum weather gardening travel-guide history school recipes science university hospital chess-club local-news
railways botany cooking-class poetry-review city-council astronomy language-forum developer-docs climate-data open-maps orchestra
swimming book-reviews""".split()
_FORMS = ["http://{h}.com/articles/{n}", "https://www.{h}.net/{n}.html", "https://blog.{h}.org/posts/{n}?page=2", "http://m.{h}.co.uk/{n}/", "https://{h}.example.org/en/{n}#top", "https://blog.{h}.example.net/en/{n}", "https://www.{h}.example.com/fr/{n}"]
LABELLED = [(_FORMS[(i + j) % len(_FORMS)].format(h=h, n=(137 * i + 71 * j) % 1000), y) for y, hosts in ((1, SPAM_HOSTS), (0, GOOD_HOSTS)) for i, h in enumerate(hosts) for j in (0, 2, 4)]


def split_url(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and unchanged path."""
    at = F.instr(url, "://")
    tail = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(tail, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest rule that fits, else nulls. The rules are a literal list."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def buckets(host: Column, path: Column) -> Column:
    """Buckets of the 3- and 4-grams of ^host$ and ^path$, and of a bias gram."""

    def of(mark: str, text: Column) -> Column:
        t = F.concat(F.lit(mark + "^"), text, F.lit("$"))
        n = F.length(t)

        def cut(k: int) -> Column:
            some = F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: t.substr(i, F.lit(k)))
            return F.when(n >= k, some).otherwise(F.array().cast("array<string>"))

        return F.concat(cut(3), cut(4))

    grams = F.concat(of("h", host), of("p", path), F.array(F.lit("bias")))
    return F.transform(grams, lambda g: F.conv(F.substring(F.md5(g), 1, 3), 16, 10).cast("int"))


def train(spark: SparkSession, labelled: list[tuple[str, int]] = LABELLED) -> list[float]:
    """Weights by bucket. Dual form: w = sum of a_i x_i, so the matrix has a row and column per labelled url."""
    values = ", ".join(f"({i}, '{u.replace(chr(39), chr(39) * 2)}', {float(y)}D)" for i, (u, y) in enumerate(labelled))
    host, path = split_url(F.col("url"))
    x = spark.sql(f"SELECT * FROM VALUES {values} AS t(i, url, y)").select("i", "y", F.explode(buckets(host, path)).alias("b")).groupBy("i", "y", "b").agg(F.count("*").cast("double").alias("c"))
    x = x.join(x.groupBy("i").agg(F.sqrt(F.sum(F.col("c") * F.col("c"))).alias("norm")), "i").select("i", "y", "b", (F.col("c") / F.col("norm")).alias("v"))
    n = len(labelled)
    gram = x.select("i", "b", "v").join(x.select(F.col("i").alias("j"), "b", F.col("v").alias("w")), "b").groupBy("i", "j").agg(F.sum(F.col("v") * F.col("w")).alias("k"))
    gram = x.select("i").distinct().select("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("j")).join(gram, ["i", "j"], "left").na.fill(0.0, ["k"])
    rows = gram.groupBy("i").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "k"))), lambda s: s["k"]).alias("row"))
    one = rows.join(x.select("i", "y").distinct(), "i").agg(F.array_sort(F.collect_list(F.struct("i", "y", "row"))).alias("m"))
    dual = one.select(
        F.expr(f"""posexplode(aggregate(sequence(1, {STEPS}), array_repeat(0D, {n}), (a, t) -> transform(a, (ai, i) ->
        ai * (1 - {RATE * DECAY}D) - {RATE}D * (1 / (1 + exp(-aggregate(zip_with(m[i].row, a, (p, q) -> p * q), 0D, (s, z) -> s + z))) - m[i].y) / {n})))""").alias("i", "a")
    )
    w = x.join(dual, "i").groupBy("b").agg(F.sum(F.col("a") * F.col("v")).alias("w"))
    got = w.agg(F.map_from_entries(F.collect_list(F.struct("b", "w"))).alias("w")).first()["w"] or {}
    return [got.get(b, 0.0) for b in range(BUCKETS)]


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, labelled: list[tuple[str, int]] = LABELLED) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the model's probability of "block") for every row."""
    weights = train(pages.sparkSession, labelled)
    host, path = split_url(F.col("url"))
    cut = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    w = F.expr("array(" + ",".join(f"{x!r}D" for x in weights) + ")")
    b = buckets(F.col("host"), F.col("path"))
    counts = F.aggregate(b, F.lit(0.0), lambda s, i: s + F.get(w, i))
    cut = cut.withColumn("rule", rule).withColumn("by_rule", verdict).withColumn("z", counts)
    return cut.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.when(F.col("z") >= 0, "block").otherwise("allow")).alias("verdict"), (1 / (1 + F.exp(-F.col("z")))).alias("score"))
