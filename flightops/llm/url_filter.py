"""URL filter: domain rules first, then gradient-boosted trees on lexical features.

A rule `host/path` fits its host and all subdomains if the url's path begins
with the rule's path; the longest rule that fits decides. What no rule decides
goes to boosted trees over the url's length, depth, digit share, character
entropy, parameter and hyphen counts, and over how often urls with its last one
and last two host labels are blocked among the labelled urls (without the url's
own row while training, smoothed to the overall share). DataFrame functions and
Spark ML only; the pages' urls are the only column read, and no row moves.

* host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased;
  path: then up to `?`, `#` or the end; null or no `://`: both empty, and the
  trees judge the url as it is (null as empty).
* labelled urls: null urls or labels are ignored; of more than `max_labelled`
  rows those with the smallest hash of the url are used, which also bounds the
  suffix table that is broadcast. One class only: no trees, all is that class.
* an empty table gives no rows; repeated rows are judged one by one; a very long url is one value of one row, no row moves.
* other columns pass through; host, path, rule and verdict replace columns of those names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (rule, verdict)
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
MAX_LABELLED = 20_000
#: Labelled urls that count as the smoothing share's weight.
SMOOTH = 4.0

#: Labelled urls, written by hand after common kinds of addresses: 1 is unwanted.
LABELLED = [(u, 0) for u in """
https://www.library.example.org/en/catalogue/1204 https://museum.example.org/fr/12 http://news.example.net/de/840.html https://blog.gardens.example.com/en/77
https://www.city.example.org/services/permits https://m.weather.example.net/en/31?page=2&ref=x http://docs.kernel.example.org/en/latest/index.html
https://school.example.org/es/45#top https://www.recipes.example.com/soups/1187 http://blog.travel.example.net/en/402/ https://forum.cycling.example.org/en/9921?page=2&ref=x
https://wiki.chemistry.example.org/en/Acid https://www.railway.example.net/de/612 https://theatre.example.org/fr/883?utm_source=feed http://m.farming.example.com/es/58
https://archive.example.org/en/20391.html https://www.hospital.example.net/en/contact https://physics.example.org/en/55123 http://blog.painting.example.com/en/7#top
https://www.court.example.org/en/rulings/2019/44 https://music.example.net/de/733?utm_source=feed https://m.sports.example.org/en/1188/ http://www.books.example.org/fr/4
https://journal.example.org/en/vol12/issue3/article7 https://www.parliament.example.org/de/90 https://blog.woodwork.example.net/en/6521 http://history.example.org/es/18.html
https://www.university.example.org/en/courses/biology https://opendata.example.net/en/sets/11?page=3 https://translate.example.org/fr/700#top http://www.harbour.example.net/en/64
https://radio.example.org/de/219/ https://m.gardening.example.net/en/8811?page=2&ref=x https://www.choir.example.org/es/92 http://blog.astronomy.example.org/en/301?utm_source=feed
https://water.example.org/en/3 https://www.market.example.com/fr/4451.html https://energy.example.net/de/27 https://www.zoo.example.org/en/visit http://films.example.org/en/9?page=2&ref=x
""".split()] + [(u, 1) for u in """
http://casino-bonus.example.net/en/14?page=2&ref=x https://free-spins.example.org/win/9 http://best-bets.example.com/en/27#top https://m.adult-cams.example.net/en/196 http://ads-server.example.org/click?id=8872&c=3&u=77
https://cheap-pills.example.net/buy/now https://www.win-money.example.org/fr/14 http://spam-links.example.net/es/750?page=2&ref=x https://track-clicks.example.com/r?u=88121&s=2&k=9&z=1 http://hot-dates.example.org/en/33/
https://x99-offers.example.net/en/5 http://www.poker-room.example.net/de/771.html https://blog.slot-games.example.org/en/402?utm_source=feed http://pay-day.example.com/loans/apply?ref=771&src=ad&cmp=31
https://m.casino-vip.example.org/en/61#top http://porn-x.example.net/fr/98 https://lucky-spin.example.org/de/45?page=2&ref=x http://ad-track.example.net/en/210/ https://free-gifts.example.com/es/18
http://click-farm.example.org/en/7301 https://bet-now.example.net/en/88.html http://www.adult-hub.example.org/es/5 https://m.link-farm.example.net/de/667?utm_source=feed http://bonus-codes.example.org/fr/32#top
https://seo-links.example.net/en/1201 http://fast-cash.example.org/en/456?page=2&ref=x https://www.sex-chat.example.net/de/20 http://fake-bags.example.com/en/903 https://xxx-tube.example.org/en/15/
http://a8f3k2q9.example.net/x7/91823/aa81?u=912&k=88&t=2 https://q7w2z0v5t1.example.org/8817/2231/9912 http://k3j9d8s7a6.example.net/go?d=99182&h=8a7f6e5d http://77231.example.org/en/1?p=1&q=2&r=3
https://pop-ads.example.net/fr/302.html http://www.cash-win.example.org/en/14 https://blog.free-poker.example.net/es/77#top http://spam-mail.example.org/de/61?page=2&ref=x https://m.big-bets.example.net/en/9
""".split()]

_PARTS = "^(?s).*?://([^/?#]*)([^?#]*)"
FEATURES = ("url_len", "host_len", "path_len", "depth", "labels", "hyphens", "params", "digits", "host_digits",
            "url_entropy", "host_entropy", "suffix1", "suffix2")


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def rule_of(host_: Column, path_: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(longest fitting rule, its verdict); null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for text, said in sorted(rules, key=lambda r: len(r[0])):  # a longer one goes around the shorter ones
        name, slash, rest = text.partition("/")
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def _entropy(chars: str) -> Column:
    """Bits a character of an array column of single characters."""
    n = F.size(chars)
    each = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n)
    return F.when(n > 0, -F.aggregate(each, F.lit(0.0), lambda a, p: a + p * F.log2(p))).otherwise(0.0)


def _lexical(df: DataFrame, url: Column) -> DataFrame:
    """`df` with `_uf_` columns: host, path, the labels of the suffixes, and the lexical features."""
    step = df.withColumns({"_uf_url": F.coalesce(url, F.lit("")), "_uf_host": host(url), "_uf_path": path(url)})
    step = step.withColumns({"_uf_chars": F.split("_uf_url", ""), "_uf_hchars": F.array_remove(F.split("_uf_host", ""), ""),
                             "_uf_query": F.regexp_extract("_uf_url", "(?s)\\?([^#]*)", 1)})
    share = lambda s: F.coalesce(F.char_length(F.regexp_replace(s, "[^0-9]+", "")) / F.nullif(F.char_length(s), F.lit(0)), F.lit(0.0))
    return step.withColumns({
        "_uf_s1": F.substring_index("_uf_host", ".", -1), "_uf_s2": F.substring_index("_uf_host", ".", -2),
        "_uf_url_len": F.char_length("_uf_url"), "_uf_host_len": F.char_length("_uf_host"), "_uf_path_len": F.char_length("_uf_path"),
        "_uf_depth": F.size(F.array_remove(F.split("_uf_path", "/"), "")), "_uf_labels": F.size(F.split("_uf_host", "\\.")),
        "_uf_hyphens": F.char_length("_uf_host") - F.char_length(F.replace("_uf_host", F.lit("-"), F.lit(""))),
        "_uf_params": F.when(F.length("_uf_query") > 0, F.size(F.split("_uf_query", "&"))).otherwise(0),
        "_uf_digits": share("_uf_url"), "_uf_host_digits": share("_uf_host"),
        "_uf_url_entropy": _entropy("_uf_chars"), "_uf_host_entropy": _entropy("_uf_hchars"),
    }).drop("_uf_chars", "_uf_hchars", "_uf_query", "_uf_url")


@dataclass
class Model:
    """Trees, and the labelled urls' blocked and all counts by suffix; or the only class seen."""
    trees: GBTClassificationModel | None
    suffixes: DataFrame  # (suffix, bad, n)
    share: float
    only: float

    def features(self, df: DataFrame, own: Column | None = None) -> DataFrame:
        """Adds the suffix shares; `own` is the row's label while training, which is then left out."""
        for k in ("1", "2"):
            table = self.suffixes.select(F.col("suffix").alias(f"_uf_s{k}"), F.col("bad").alias(f"_uf_bad{k}"), F.col("n").alias(f"_uf_n{k}"))
            df = df.join(F.broadcast(table), f"_uf_s{k}", "left")  # at most two rows a labelled url
            bad, n = F.coalesce(f"_uf_bad{k}", F.lit(0.0)), F.coalesce(f"_uf_n{k}", F.lit(0))
            if own is not None:
                bad, n = bad - own, n - 1
            df = df.withColumn(f"_uf_suffix{k}", (bad + SMOOTH * self.share) / (n + SMOOTH))
        return VectorAssembler(inputCols=[f"_uf_{f}" for f in FEATURES], outputCol="_uf_vector").transform(df)


def labelled_table(spark: SparkSession, rows=LABELLED) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for u, y in rows])))


def fit(labelled: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = 20, depth: int = 3, seed: int = 7) -> Model:
    """Trees from (url, label 0/1)."""
    rows = (labelled.where("url is not null and label is not null").select("url", F.col("label").cast("double").alias("label"))
            .orderBy(F.xxhash64("url"), "url", "label").limit(max_labelled))
    rows = _lexical(rows, F.col("url")).select("label", *[f"_uf_{f}" for f in (*FEATURES[:-2], "s1", "s2")]).cache()
    n, bad = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    suffixes = (rows.select("label", F.explode(F.array_distinct(F.array("_uf_s1", "_uf_s2"))).alias("suffix"))
                .groupBy("suffix").agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("n")))
    model = Model(None, suffixes, (bad or 0.0) / n if n else 0.0, 1.0 if n and bad == n else 0.0)
    if n and 0 < bad < n:
        given = model.features(rows, F.col("label")).select("label", "_uf_vector")
        trees = GBTClassifier(labelCol="label", featuresCol="_uf_vector", maxIter=rounds, maxDepth=depth, seed=seed)
        trees = trees.setPredictionCol("_uf_prediction").setRawPredictionCol("_uf_raw").setProbabilityCol("_uf_probability")
        model.trees = trees.fit(given)
    return model


def judge(pages: DataFrame, model: Model, rules: list[tuple[str, str]] = RULES, url_col: str = "url") -> DataFrame:
    """`pages` with host, path, rule and verdict."""
    done = model.features(_lexical(pages, F.col(f"`{url_col}`")))
    if model.trees is not None:
        done = model.trees.transform(done)
        unwanted = F.col("_uf_prediction") == 1.0
    else:
        unwanted = F.lit(model.only == 1.0)
    rule, verdict = rule_of(F.col("_uf_host"), F.col("_uf_path"), rules)
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return done.select(*[F.col(f"`{c}`") for c in names], F.col("_uf_host").alias("host"), F.col("_uf_path").alias("path"), rule.alias("rule"),
                       F.coalesce(verdict, F.when(unwanted, "block").otherwise("allow")).alias("verdict"))


def digest(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Contract columns of op3 over pages."""
    return judge(pages.select("page_id", "url"), fit(labelled_table(spark))).select("page_id", "host", "path", "rule", "verdict")
