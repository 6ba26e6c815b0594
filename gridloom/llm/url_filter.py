"""URL verdicts by host and path rules, else by logistic regression on character n-grams.

DataFrame functions and the built-in classifier only; nothing runs in Python workers.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Up to so many rules are held against every host in one expression; more are joined.
_INLINE_RULES = 200

# A small labelled table of invented hosts of many kinds.  There are twice as many to allow, so
# that a host without any known piece of a word is allowed.
BLOCKED = """
http://casino-royal.example.org/en/12          https://www.grand-casino.test/play             https://online-casino-win.test/en/8
http://poker-stars-club.invalid/es/8           https://free-poker.test/join                   https://lucky-slots.test/de/4
http://slots-jackpot.invalid/fr/2              https://jackpot-city.example.org/en/1          https://roulette-online.test/spin
https://sports-bets.test/odds                  http://free-bets-now.test/de/3                 https://best-betting.invalid/en/77
http://live-bet.example.org/es/10              https://lottery-winner.test/claim              https://blackjack-bonus.test/en/6
https://cheap-pills-online.test/en/1           http://www.pills-4-you.invalid/buy             https://cheap-meds.test/order/22
http://discount-meds.example.org/fr/9          https://viagra-discount.test/en/3              https://cheap-viagra.invalid/de/2
http://buy-cialis-online.test/en/5             https://no-prescription-rx.test/fr/1           https://fast-weight-loss-pills.test/en/9
https://adult-videos.test/en/5                 http://www.adult-chat.invalid/x                https://hot-adult-dating.test/de/31
http://xxx-movies.test/en/18                   https://free-xxx.invalid/es/4                  http://free-porn.test/en/1
https://porn-tube.example.org/fr/7             https://live-sex-cams.test/en/2                http://sexy-girls-chat.invalid/en/3
https://adults-only.test/en/3                  http://best-adult-sites.invalid/fr/6           https://adultfriend.example.org/es/2
https://free-money-win.test/en/40              http://win-big-cash.invalid/fr/4?ref=x         https://easy-cash-now.test/en/2
http://payday-loans-fast.test/apply            https://instant-loans.example.org/en/8         http://get-rich-quick.test/de/1
https://double-your-bitcoin.test/en/7          http://bitcoin-profit-now.invalid/es/3         https://claim-your-prize.test/en/11
https://free-iphone-winner.test/fr/6           http://you-won-gift-card.invalid/en/9          https://spam-links.test/en/2
http://link-spam-farm.invalid/a                https://buy-backlinks-cheap.test/en/4          https://www.seo-farm.test/rank/6
http://seo-links-4-sale.test/en/3              https://buy-followers-now.test/en/64           http://cheap-traffic-bot.invalid/de/5
https://ads-server.test/banner                 http://click-track-ads.invalid/en/14           https://ad-tracker.test/pixel
https://popup-ads.example.org/fr/3             http://adclick-network.test/en/1               https://replica-watches-sale.test/en/8
http://fake-rolex-cheap.invalid/fr/2           https://cheap-replica-bags.test/es/9           http://free-keygen-crack.test/dl
https://cracked-software-free.invalid/en/6     http://watch-free-movies-now.test/de/8         https://free-download-warez.test/en/3
"""
ALLOWED = """
https://library.example.org/en/12              http://www.cityschool.test/en/8                https://news.northriver.invalid/fr/4
https://dailyherald.test/2024/05/story         https://morning-post.example.org/en/77         http://www.zeitung-heute.test/politik
https://lejournal.invalid/fr/9                 https://elperiodico.test/es/10                 http://evening-times.test/sport/3
https://www.university.test/en/3               http://physics.stateuniversity.invalid/en/1    https://hochschule-nord.test/de/8
https://college-of-arts.example.org/en/40      http://institute-of-chemistry.test/papers      https://academia.invalid/es/2
https://museum.invalid/en/1                    http://nationalgallery.test/exhibits/6         https://sussex-museum.test/en/5
https://theatre-royal.test/tickets             http://opera-house.invalid/de/14               https://www.cityarchive.example.org/fr/6
https://weather.station.test/es/10             https://wetterdienst.invalid/de/7              http://meteo.test/fr/20
https://ministry-of-health.test/en/9           http://www.parliament.invalid/acts/18          https://city-council.example.org/en/31
https://rathaus.test/de/3                      http://mairie-du-village.invalid/fr/17         https://ayuntamiento.test/es/19
https://worldhealth.invalid/en/64              http://children-hospital.test/en/2             https://dentist-brown.example.org/en/5
https://public-law.test/cases/88               http://human-rights.invalid/en/4               https://consumer-advice.test/en/12
https://developer-docs.test/guide/7            http://opensource.invalid/projects/21          https://code-hosting.test/repo/wiki
https://software-manual.example.org/en/6       http://linux-users.test/forum/55               https://python-lessons.invalid/en/3
https://encyclopedia.test/wiki/Moon            http://dictionary.invalid/en/word              https://mathnotes.test/fr/9
https://recipes.kitchen.example.org/en/1       http://grandmas-cooking.test/en/13             https://bakery-miller.invalid/de/5
https://blog.gardenhouse.test/de/3             http://gardening.example.org/es/5              https://rose-growers.test/en/22
https://bird-watching.invalid/en/8             http://mountain-hiking.test/trails/4           https://cycling-club.example.org/fr/2
https://football-league.test/results           http://chess-federation.invalid/en/10          https://tennis-verein.test/de/6
https://www.harbour.invalid/de/7               http://railway-timetable.test/en/15            https://airport.test/arrivals
https://travel-guide.invalid/es/30             http://hotel-seaview.test/en/9                 https://camping-au-lac.example.org/fr/3
https://bookshop.test/novels/11                http://furniture-maker.invalid/en/2            https://bicycle-repair.test/en/17
https://farmers-market.example.org/en/7        http://wine-cellar.test/fr/12                  https://toy-store.invalid/en/4
https://music.lessons.test/fr/6                http://jazz-orchestra.invalid/en/5             https://choir-of-saint-mary.test/en/1
https://blog.astronomy.test/es/8               http://m.thehistory.invalid/en/77              https://geology-today.test/en/44
https://photography-anna.example.org/en/3      http://johnsmith.test/about                    https://maria-garcia.invalid/es/6
https://schneider-und-sohn.test/de/9           http://dupont-architectes.invalid/fr/8         https://petersen-law.test/en/2
https://village-church.test/en/10              http://charity-for-children.invalid/give       https://red-cross-nurses.test/en/5
https://scout-group.example.org/en/21          http://rotary-club.test/en/7                   https://volunteer-fire-brigade.invalid/de/2
https://parents-forum.test/en/90               http://language-exchange.invalid/fr/33         https://pen-friends.test/es/12
https://radio-station.test/live                http://podcast-stories.invalid/en/8            https://film-festival.test/en/6
https://science-magazine.example.org/en/60     http://nature-reserve.test/en/14               https://ocean-research.invalid/en/28
https://economics-review.test/en/3             http://stock-exchange.invalid/en/19            https://savings-bank.test/de/4
https://insurance-guide.example.org/en/9       http://job-centre.test/vacancies/5             https://housing-office.invalid/en/6
https://essex-county.test/en/2                 http://cashel-castle.invalid/en/7              https://adult-education.example.org/courses
https://alphabet-games.test/kids/3             http://betty-bakes.invalid/en/16               https://track-and-field.test/en/8
https://discount-rail-pass.test/en/1           http://free-library-books.invalid/en/4         https://online-courses.test/en/25
https://best-of-poetry.example.org/en/2        http://winter-sports.test/de/11                https://medieval-art.invalid/fr/5
https://old-maps.test/es/7                     http://family-tree.invalid/en/35               https://knitting-patterns.test/en/9
https://forest-school.example.org/en/6         http://sailing-school.test/de/12               https://clockmakers.invalid/fr/4
https://primary-school.test/en/1               http://teachers-union.invalid/en/13            https://student-paper.test/en/18
https://water-board.example.org/en/5           http://energy-agency.test/en/10                https://bridge-engineers.invalid/de/8
"""


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://`` or for null."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(text, pattern, 2)


def _grams(text: Column, tag: str, sizes: tuple[int, ...]) -> Column:
    """Tagged character n-grams, in one pass over the characters; digits are alike."""
    letters = F.split(F.concat(F.lit("^"), F.translate(text, "0123456789", "0000000000"), F.lit("$")), "")

    def of(n: int) -> Column:
        last = F.size(letters) - n
        places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat(F.lit(tag), *[F.get(letters, i + k) for k in range(n)]))

    return F.concat(*[of(n) for n in sizes])


def url_features(df: DataFrame, host: str = "host", path: str = "path", out: str = "grams") -> DataFrame:
    return df.withColumn(out, F.concat(_grams(F.col(host), "h:", (3, 4)), _grams(F.col(path), "p:", (3,))))


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = [(u, 1.0) for u in BLOCKED.split()] + [(u, 0.0) for u in ALLOWED.split()]
    return spark.createDataFrame(rows, "url string, label double")


def train(labelled: DataFrame, buckets: int = 1 << 14, reg: float = 0.01) -> PipelineModel:
    """A classifier of hashed n-grams from a small table (url, label), label 1 to block."""
    host, path = url_parts(F.col("url"))
    rows = url_features(labelled.select(host.alias("host"), path.alias("path"), "label")).coalesce(1)
    hashing = HashingTF(inputCol="grams", outputCol="features", numFeatures=buckets, binary=True)
    model = LogisticRegression(maxIter=50, regParam=reg, probabilityCol="p_class", rawPredictionCol="raw", predictionCol="blocked")
    return Pipeline(stages=[hashing, model]).fit(rows)


def match_rules(urls: DataFrame, rules: list[tuple[str, str]], host: str = "host", path: str = "path") -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` of the longest fitting rule, null without one.

    A rule (``net/es/``, verdict) fits its host and all subdomains whose path starts
    with its path.  A few rules are one expression; a long list becomes a table that
    is joined on the suffixes of the host, so neither way compares all with all.
    """
    if len(rules) <= _INLINE_RULES:
        rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
        for text, what in sorted(rules, key=lambda r: (len(r[0]), r[0])):
            rule_host, rule_path = text[: text.index("/")], text[text.index("/") :]
            fits = ((F.col(host) == rule_host) | F.col(host).endswith("." + rule_host)) & F.col(path).startswith(rule_path)
            rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
        return urls.withColumns({"rule": rule, "rule_verdict": verdict})
    listed = urls.sparkSession.createDataFrame([(r[: r.index("/")], r[r.index("/") :], r, v) for r, v in rules], "rule_host string, rule_path string, rule string, rule_verdict string")
    parts = F.split(F.col("u_host"), r"\.")
    hosts = urls.select(F.col(host).alias("u_host"), F.col(path).alias("u_path")).distinct()
    suffixes = hosts.withColumn("rule_host", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))))
    found = (
        suffixes.join(listed, "rule_host")
        .where(F.col("u_path").startswith(F.col("rule_path")))
        .groupBy("u_host", "u_path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "rule_verdict")).alias("best"))
        .select("u_host", "u_path", "best.rule", "best.rule_verdict")
    )
    same = (F.col(host) == F.col("u_host")) & (F.col(path) == F.col("u_path"))
    return urls.join(found, same, "left").drop("u_host", "u_path")


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], model: PipelineModel, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and score of every page.

    The verdict is the longest fitting rule's; without a rule, ``block`` where the
    classifier gives a probability above one half, and ``allow`` where there is
    neither host nor path.  Repeated rows are judged one by one, a null id stays
    null, and an empty table gives an empty result.
    """
    host, path = url_parts(F.col(url_col))
    rows = match_rules(pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")), rules)
    scored = model.transform(url_features(rows))
    score = F.when((F.col("host") == "") & (F.col("path") == ""), F.lit(0.0)).otherwise(vector_item("p_class", 1))
    judged = F.when(score > 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", judged).alias("verdict"), score.alias("score"))


def vector_item(column: str, place: int) -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(column))[place]
