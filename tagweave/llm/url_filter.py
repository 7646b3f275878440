"""URL filter: allow/block rules first, else logistic regression on hashed n-grams.

The model reads character n-grams (3 to 5, digits as ``0``) of host and path, hashed by
crc32 into ``BUCKETS`` weights, each URL scaled to unit length.  It is trained by gradient
descent (Adagrad) on a small labelled table of URLs (at most ``MAX_LABELLED`` rows of a larger
one); per step Spark sums the gradient and the driver holds the weights (``BUCKETS`` numbers).
Everything is DataFrame functions.  The default table is invented: sites named after topics, or
after nothing, under the same domains; half of each side's paths are ordinary ones.

Cases: a null url, or one without ``://``, has empty host and path and no n-grams, so the
bias decides (allow, with the default table); a path without a leading ``/`` fits no rule;
repeated rows are judged alike; an empty table gives no rows; an empty labelled table
allows all; an input column named like an added one is replaced.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.frames import literal_frame
from tagweave.llm.common import stored

BUCKETS = 1 << 15
GRAMS = (3, 4, 5)
STEPS = 30
RATE = 0.5
L2 = 0.0001
BLOCK_SHARE = 0.4  # weight of the blocked class in training, chosen on left-out sites
MAX_LABELLED = 20_000  # rows the model is fitted on: those with the smallest hash of the url
ADDED = ["host", "path", "rule", "verdict", "block_score"]

# (host, path prefix, verdict)
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]

# topics of the invented labelled table; sites are named after one word, or two of a side
_BLOCK_WORDS = ("casino poker roulette blackjack betting bets wager jackpot slots bingo lottery pharmacy pills viagra "
                "cialis xanax tramadol steroids meds diet porn xxx adult sex nude escort webcam singles hookup milf "
                "spam backlinks seolinks linkfarm adserver ads banner tracker clicktrack popunder doubleclick payday "
                "loan forex bitcoin prize giveaway winner replica fakewatch warez torrent crack keygen malware phishing "
                "login-verify botnet").split()
_BLOCK_TAILS = "online bonus shop free best cheap hot buy tube club deals tips vip live 24 king".split()
_ALLOW_WORDS = ("news daily post library museum university school garden recipes travel weather science history journal "
                "forum wiki docs manual music film books sport cycling football council health review photo kitchen "
                "times river village city guide language theatre physics chemistry biology software notes bakery "
                "orchestra archive hospital parish railway gallery bookshop farm tractor plumber dentist hiking "
                "tracking sextant essex middlesex adsorption pilot spammer-watch lobster slot-cars").split()
_ALLOW_TAILS = "online shop best free club tips live 24 local today club blog house group lab tube".split()
_SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo za bro cli dre sto tri ther ing on al en".split()
_PREFIXES = ("", "www.", "blog.", "m.")
_DOMAINS = ("com", "net", "org", "info", "example.com", "example.net", "example.org", "co.uk", "de", "fr")
# ordinary paths occur on both sides, as blocked sites have them too; the others tell
_PLAIN_PATHS = ("/", "/en/120", "/de/33.html", "/fr/7/", "/es/981", "/index.html", "/about", "/page/4")
_BLOCK_PATHS = ("/free-spins/bonus", "/signup-bonus.html", "/buy-now/no-prescription", "/discount-meds.html", "/click?id=7",
                "/redirect/aff/33", "/xxx/videos/12", "/win/claim-prize", "/landing/offer/5", "/banner/popup.js",
                "/track/pixel.gif", "/download/crack.exe")
_ALLOW_PATHS = ("/news/2024/05/council-meeting", "/articles/history-of-the-bridge.html", "/docs/install", "/wiki/Main_Page",
                "/recipes/bread", "/contact", "/products/112", "/blog/2023/11/spring-walk/", "/events/concert",
                "/library/opening-hours", "/research/papers/8", "/videos/lecture-3")


def sites() -> list[tuple[str, int]]:
    """Invented site names and labels (1: block)."""
    out = []
    for label, words, tails in ((1, _BLOCK_WORDS, _BLOCK_TAILS), (0, _ALLOW_WORDS, _ALLOW_TAILS)):
        for k, word in enumerate(words):
            tail, other = tails[k % len(tails)], words[(7 * k + 3) % len(words)]
            out += [(name, label) for name in (word, f"{word}-{tail}", f"{tail}{word}", f"{word}-{other}", f"{other}{word}")]
    n = len(_SYLLABLES)
    # clean sites whose names mean nothing
    out += [("".join(_SYLLABLES[(k * m + j) % n] for j, m in enumerate((1, 7, 11)[:2 + k % 2])), 0) for k in range(3 * n)]
    return out


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The default labelled table ``(url, block)``: invented sites under the same domains on both sides."""
    rows = []
    for k, (name, label) in enumerate(sites()):
        telling = _BLOCK_PATHS if label else _ALLOW_PATHS
        for j in range(4):
            path = _PLAIN_PATHS[(k + j) % 8] if j % 2 else telling[(k + j) % 12]
            rows.append((f"https://{_PREFIXES[(k + j) % 4]}{name}.{_DOMAINS[(k + 3 * j) % 10]}{path}", label))
    return literal_frame(spark, rows, "url STRING, block INT")


def host_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", ""))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def _grams(text: Column, tag: str) -> Column:
    text = F.regexp_replace(text, "[0-9]", "0")

    def of(n: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
        return F.transform(places, lambda i: F.concat(F.lit(tag), F.substring(text, i, F.lit(n))))

    parts = [of(n) for n in GRAMS]
    return F.when(F.length(text) > 0, F.concat(*parts)).otherwise(F.array().cast("array<string>"))


def features(host: Column, path: Column) -> Column:
    """Distinct bucket numbers 1..BUCKETS of a URL's n-grams (0 is the bias)."""
    return F.array_distinct(F.transform(F.concat(_grams(host, "h"), _grams(path, "p")),
                                        lambda g: (F.pmod(F.crc32(g.cast("binary")), F.lit(BUCKETS)) + 1).cast("int")))


def _margin(weights: list[float], found: Column) -> Column:
    w = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    total = F.aggregate(found, F.lit(0.0), lambda acc, i: acc + F.get(w, i))
    return F.lit(weights[0]) + F.when(F.size(found) > 0, total / F.sqrt(F.size(found))).otherwise(F.lit(0.0))


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "block") -> list[float]:
    """Weights (bias first) by full-batch gradient descent (Adagrad, L2) on ``labelled``.

    Rows with a null label are left out; the blocked ones weigh ``BLOCK_SHARE`` in total.
    """
    url = F.col(url_col).cast("string")
    known = labelled.where(F.col(label_col).isNotNull()).select(url.alias("url"), F.col(label_col).cast("double").alias("y"))
    host, path = host_path(F.col("url"))
    rows = known.orderBy(F.xxhash64("url"), "url", "y").limit(MAX_LABELLED).select(features(host, path).alias("found"), "y")
    rows = stored(rows, "url-labelled").coalesce(1)  # MAX_LABELLED rows: one task, no exchange
    sizes = dict(rows.groupBy("y").agg(F.count(F.lit(1))).collect())
    weights = [0.0] * (BUCKETS + 1)
    if len(sizes) < 2:
        return weights if sizes.get(1.0, 0) == 0 else [1.0] + weights[1:]
    share = F.when(F.col("y") == 1, BLOCK_SHARE / sizes[1.0]).otherwise((1 - BLOCK_SHARE) / sizes[0.0])
    seen = [1e-12] * len(weights)  # Adagrad: each weight's step shrinks with its own gradients
    for _ in range(STEPS):
        residual = (F.lit(1.0) / (F.lit(1.0) + F.exp(-_margin(weights, F.col("found")))) - F.col("y")) * share
        step = rows.select(residual.alias("r"), F.explode(F.concat(F.array(F.lit(0)), "found")).alias("i"),
                           F.sqrt(F.greatest(F.size("found"), F.lit(1))).alias("norm"))
        gradient = step.groupBy("i").agg(F.sum(F.when(F.col("i") == 0, F.col("r")).otherwise(
            F.col("r") / F.col("norm"))).alias("g")).collect()
        for i, g in gradient:
            g += L2 * weights[i] * (i > 0)
            seen[i] += g * g
            weights[i] -= RATE * g / seen[i] ** 0.5
    return [round(w, 9) for w in weights]


def judge(pages: DataFrame, weights: list[float], rules: list[tuple[str, str, str]] = RULES,
          url_col: str = "url") -> DataFrame:
    """``pages`` with ``host path rule verdict block_score`` (the model's margin)."""
    host, path = host_path(F.col(url_col).cast("string"))
    rows = pages.drop(*ADDED).withColumns({"host": host, "path": path})
    # the longest rule first, so the first that fits wins
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    rows = rows.withColumns({"rule": rule, "_verdict": verdict,
                             "block_score": _margin(weights, features(F.col("host"), F.col("path")))})
    learned = F.when(F.col("block_score") > 0, "block").otherwise("allow")
    return rows.withColumn("verdict", F.coalesce("_verdict", learned)) \
        .select(*[c for c in pages.columns if c not in ADDED], *ADDED)
