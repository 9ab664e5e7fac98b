"""URL filter: rules first, else logistic regression on hashed character n-grams.

Each URL is split into host and path. A rule fits its host and all subdomains where the path
starts with the rule's path; the longest fitting rule decides. For all other URLs a logistic
regression judges presence of hashed character n-grams of host and path. It is trained from a
small labelled URL table (a parameter of bounded size; `SEED_URLS` by default) in numpy on the
driver; its weights have a fixed size and travel with the tasks. The default table holds typical
words of gambling, pharmacy, adult, advertising and fraud sites, and no host of any input; sizes
of n-grams, rounds and decay were chosen by cross-validation on that table alone.

Defined cases: a null URL or one without `://` has empty host and path, fits no rule, and is
judged by the model on the empty string; rows are independent, so repeated rows get equal
results; long URLs are read whole; an empty table gives no rows; extra columns are kept by
`judge_urls` unless named like an added one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import packed, table, unpacked

# The rules, and the labelled URLs that the model learns from.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
BLOCKED_URLS = """
https://royalcasino.test/welcome-bonus http://www.luckyslots.test/free-spins https://grandjackpot.test/play-now
http://pokernight.test/join https://betting-odds.test/live https://www.sportsbet.test/odds/today http://bingo-hall.test/bonus
https://roulette-live.test/table/4 http://blackjack-room.test/play https://vegas-spins.test/claim http://online-casino-guide.test/top10
https://bet-now.test/signup http://slots-paradise.test/win https://lottery-winner.test/claim-prize http://bookmaker-tips.test/bets
https://discountpharmacy.test/order http://onlinepills.test/buy-now https://viagra-order.test/cart http://cialis-direct.test/no-prescription
https://dietpills.test/offer http://weightloss-miracle.test/buy https://steroids-shop.test/checkout http://rx-meds.test/cheap
https://adult-cams.test/live http://xxxvideos.test/watch https://sexchat.test/join-free http://hot-singles.test/meet
https://nude-pics.test/gallery http://escort-guide.test/city https://adultdating.test/signup http://porn-tube.test/v/12
https://adserver.test/click?id=4 http://ad-click.test/redirect https://clicktracker.test/px.gif http://popunder.test/js
https://tracking-pixel.test/t.gif http://banner-exchange.test/serve https://affiliate-links.test/go/88 http://adnetwork.test/imp
https://ads-delivery.test/slot http://track-visitor.test/collect https://linkfarm.test/page/991 http://spam-mailer.test/send
https://get-rich-quick.test/secret http://free-money.test/claim https://crypto-doubler.test/invest http://win-iphone.test/prize
https://prize-claim.test/winner http://payday-loans.test/apply-now https://cheap-replica.test/sale http://replica-watches.test/discount
https://cheap-loans.test/apply http://seo-backlinks.test/buy https://bulk-email.test/order http://free-gift-cards.test/get
https://malware-download.test/setup.exe http://keygen-crack.test/serial https://warez-serial.test/free http://phishing-login.test/verify
""".split()
ALLOWED_URLS = """
https://citynews.test/politics/2021/budget http://www.publiclibrary.test/catalogue https://gardening.test/roses/pruning
http://weather-service.test/forecast https://university.test/departments/physics http://museum.test/exhibitions/current
https://recipes.test/soups/lentil http://travelnotes.test/portugal/lisbon https://worldhistory.test/rome/republic
http://astronomy.test/planets/saturn https://radio.test/programmes http://townhall.test/council/minutes
https://cooking-forum.test/threads/4412 http://classical-music.test/composers https://hospital.test/visiting-hours
http://primaryschool.test/term-dates https://railways.test/timetable http://bookreviews.test/fiction/2019
https://birdwatching.test/guides/owls http://carpentry.test/joints https://chess-club.test/openings http://mountaineering.test/alps
https://encyclopedia.test/wiki/Photosynthesis http://dictionary.test/word/lantern https://theatre.test/season http://folklore.test/tales
https://geology.test/minerals/quartz http://economics.test/papers/trade https://philosophy.test/ethics http://poetry.test/sonnets
https://software-docs.test/reference/install http://opensource.test/projects https://mathematics.test/algebra/groups http://biology.test/cells
https://parliament.test/debates http://lawreview.test/articles/contract https://architecture.test/bridges http://oceanography.test/tides
https://painting.test/watercolour http://photography.test/lenses https://cycling.test/routes http://marathon.test/training
https://farming.test/crops/barley http://beekeeping.test/hives https://knitting.test/patterns http://orchestra.test/concerts
https://translation.test/essays http://linguistics.test/grammar https://archaeology.test/digs http://genealogy.test/records
https://engineering.test/turbines http://chemistry.test/elements/iron https://cinema.test/reviews http://journalism.test/archive
https://blog.winterwalks.test/january http://m.harbour.test/ferries https://blog.teashop.test/green-tea http://www.neighbours.test/street
""".split()
SEED_URLS = [(u, 1) for u in BLOCKED_URLS] + [(u, 0) for u in ALLOWED_URLS]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Sizes of the character n-grams, and the number of hashed features.
NGRAMS = (2, 3, 4)
FEATURES = 1 << 16
#: Rows of the labelled table at most: what the driver holds while it trains.
LABELLED_ROWS = 50_000


def split_url(url: Column) -> tuple[Column, Column]:
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return (
        F.translate(F.coalesce(F.regexp_extract(url, parts, 1), F.lit("")), UPPER, LOWER),
        F.coalesce(F.regexp_extract(url, parts, 2), F.lit("")),
    )


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: len(r[1])):
        top, slash, rest = rule.partition("/")
        fits = ((host == top) | host.endswith("." + top)) & path.startswith(slash + rest)
        name = F.when(fits, rule).otherwise(name)
        verdict = F.when(fits, what).otherwise(verdict)
    return name, verdict


def _ngrams(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams of the host with its ends marked, and of the path."""
    found = set()
    for kind, text in (("h", f"^{host}$"), ("p", path)):
        for n in NGRAMS:
            for k in range(len(text) - n + 1):
                found.add(zlib.crc32(f"{kind}{text[k : k + n]}".encode()) % FEATURES)
    return np.fromiter(sorted(found), np.int64, len(found))


def _split(url: str | None) -> tuple[str, str]:
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    ends = [k for k in (rest.find(c) for c in "/?#") if k >= 0]
    cut = min(ends, default=len(rest))
    path = rest[cut:]
    stops = [k for k in (path.find(c) for c in "?#") if k >= 0]
    return rest[:cut].translate(str.maketrans(UPPER, LOWER)), path[: min(stops, default=len(path))]


def train_url_model(labelled: list[tuple[str, int]], rounds: int = 1500, rate: float = 2.0, decay: float = 1e-4) -> np.ndarray:
    """Weights and, last, the intercept, by gradient descent."""
    if len(labelled) > LABELLED_ROWS:
        raise ValueError(f"more than {LABELLED_ROWS} labelled URLs")
    rows = [_ngrams(*_split(url)) for url, _ in labelled]
    truth = np.array([y for _, y in labelled], float)
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.concatenate(rows) if rows else np.empty(0, np.int64)
    scale = np.array([1 / np.sqrt(max(len(r), 1)) for r in rows])
    weights, intercept = np.zeros(FEATURES), 0.0
    for _ in range(rounds if rows else 0):
        z = np.bincount(at, weights[feature], len(rows)) * scale + intercept
        miss = 1 / (1 + np.exp(-z)) - truth
        weights -= rate * (np.bincount(feature, (miss * scale)[at], FEATURES) / len(rows) + decay * weights)
        intercept -= rate * miss.mean()
    return np.append(weights, intercept)


def judge_urls(
    pages: DataFrame, labelled: list[tuple[str, int]] = SEED_URLS, rules=RULES, url_col: str = "url", limit: float = 0.5
) -> DataFrame:
    """`pages` with host, path, rule, the model's probability `p_block`, and the verdict."""
    weights = pages.sparkSession.sparkContext.broadcast(train_url_model(labelled))

    @F.pandas_udf("double")
    def score(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        w = weights.value
        out = np.empty(len(hosts))
        for k, (host, path) in enumerate(zip(hosts, paths)):
            grams = _ngrams(host, path)
            z = w[grams].sum() / np.sqrt(max(len(grams), 1)) + w[-1]
            out[k] = 1 / (1 + np.exp(-z))
        return pd.Series(out)

    host, path = split_url(F.col(f"row.`{url_col}`").cast("string"))
    split = packed(pages, "row").withColumns({"own_host": host, "own_path": path})
    name, verdict = rule_for(F.col("own_host"), F.col("own_path"), rules)
    scored = split.withColumn("p", score("own_host", "own_path"))
    return unpacked(
        scored,
        "row",
        {
            "host": F.col("own_host"),
            "path": F.col("own_path"),
            "rule": name,
            "p_block": F.col("p"),
            "verdict": F.coalesce(verdict, F.when(F.col("p") >= limit, "block").otherwise("allow")),
        },
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict", "p_block")
