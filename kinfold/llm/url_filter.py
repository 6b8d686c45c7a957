"""URL filters: rules by longest match, else a logistic regression on hashed character n-grams."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

# Fixed rules: verdict, host, path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

# Labelled urls to learn from, host and path: 1 is to be blocked. Common names of spam and of ordinary sites; none is taken
# from the pages of the repository, so that those are held out.
_SPAM = (
    "pills-online buy-viagra viagra-shop cialis-store pharma-discount rx-meds-cheap generic-pharmacy weight-loss-pills casino-bonus "
    "online-casino royal-casino vegas-casino-slots poker-bonus slots-jackpot bet-bonus sports-betting best-bets-today live-roulette "
    "adult-cams adult-dating xxx-video porn-tube sex-chat hot-singles nude-cams escort-girls link-farm seo-spam buy-backlinks "
    "spam-mailer bulk-email-leads ad-click click-ads popads-server ads-exchange adserver-track tracking-pixel clicktracker "
    "free-prizes free-iphone-win lottery-winner claim-reward win-cash-now payday-loan fast-loans-cash crypto-doubler "
    "bitcoin-profit forex-signals-vip get-rich-quick malware-download warez-crack keygen-serial torrent-free-movies "
    "replica-watches fake-rolex essay-writers-cheap cheap-handbags-outlet miracle-cure hack-followers buy-followers"
).split()
_CLEAN = (
    "news blog wiki library museum weather school garden history science docs forum recipes travel health music sports maps "
    "city-council archive books journal courses photo-club open-data local-news the-times art-house research language university "
    "hospital theatre orchestra railway airport parliament court-records fishing-club chess-federation mathematics physics-letters "
    "biology-notes gardening-tips bread-baker mountain-hiking river-trust harbour-town northfield oakwood-primary stmary-church "
    "johnson-family smith-and-sons anderson-law miller-dental blueprint-studio greenhouse-cafe redbrick-bakery softwarefoundation "
    "linux-users python-meetup java-tutorials developer-handbook openstreet encyclopedia dictionary translator thesaurus "
    "heritage-trust thornbury netherton thurston enderby leighton wintersong bergmann lehrer stadtarchiv bibliotheque lemonde-diplo "
    "universidad noticias gazeta tidning retail-bank insurance-group post-office freedom-of-press winchester cheapside adelaide"
).split()
LABELLED = [
    (prefix + host + ending, path, label)
    for label, hosts, paths in (
        (1, _SPAM, ["/", "/buy", "/index.html", "/click", "/item/12345", "/offer/free"]),
        (0, _CLEAN, ["/", "/about", "/index.html", "/2021/03/title", "/item/12345", "/contact"]),
    )
    for i, host in enumerate(hosts)
    for j, ending in enumerate((".com", ".net", ".org", ".info"))
    for prefix, path in [(("", "www.", "m.", "blog.")[(i + j) % 4], paths[(i + j) % len(paths)])]
]
# Where cross-validation by host over LABELLED errs least, see ``chosen_threshold``.
THRESHOLD = 0.35
MAX_LABELLED = 10_000  # rows that a fit accepts; the table is small by contract


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    from .common import ascii_lower

    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(F.coalesce(after, F.lit("")))


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; a rule fits its host, all subdomains, and its paths' starts."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in reversed(ordered):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def features(host: str, path: str, orders: Sequence[int], bits: int) -> np.ndarray:
    """Distinct buckets of the character n-grams of host and path, which do not share n-grams."""
    out = []
    for salt, part in ((1, f"^{host}$"), (2, f"^{path}$")):
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        h = np.full(len(c), salt, dtype=np.uint64)
        for n in range(1, max(orders) + 1):
            if len(c) < n:
                break
            h = (h[: len(c) - n + 1] ^ c[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
            if n in orders:
                out.append((h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits))
    return np.unique(np.concatenate(out)).astype(np.int64) if out else np.zeros(0, dtype=np.int64)


class UrlModel:
    """Logistic regression with an L2 penalty, fitted by full gradient steps on a small table."""

    def __init__(self, orders: Sequence[int] = (3, 4, 5), bits: int = 16, penalty: float = 1e-4, steps: int = 600, rate: float = 20.0):
        self.orders, self.bits, self.penalty, self.steps, self.rate = tuple(orders), bits, penalty, steps, rate
        self.weights, self.bias = np.zeros(1 << bits), 0.0

    def fit(self, rows: Sequence[tuple[str, str, int]]) -> UrlModel:
        if len(rows) > MAX_LABELLED:
            raise ValueError(f"more than {MAX_LABELLED} labelled urls")
        x = [features(h, p, self.orders, self.bits) for h, p, _ in rows]
        y = np.array([label for _, _, label in rows], dtype=float)
        if not len(rows):
            return self
        length = np.array([max(1, len(f)) for f in x])
        row, col = np.repeat(np.arange(len(x)), [len(f) for f in x]), np.concatenate(x)
        value = (1 / np.sqrt(length))[row]
        for _ in range(self.steps):
            z = np.bincount(row, weights=self.weights[col] * value, minlength=len(x)) + self.bias
            gap = 1 / (1 + np.exp(-z)) - y
            grad = np.bincount(col, weights=gap[row] * value, minlength=len(self.weights)) / len(x)
            self.weights -= self.rate * (grad + self.penalty * self.weights)
            self.bias -= gap.mean()
        return self

    def score(self, host: str, path: str) -> float:
        f = features(host, path, self.orders, self.bits)
        z = self.weights[f].sum() / math.sqrt(max(1, len(f))) + self.bias
        return float(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))))


def site_of(host: str) -> str:
    """The name of a labelled host without prefix and ending."""
    return re.sub(r"^(www|m|blog)\.(?=.*\.)", "", host).split(".")[0]


def chosen_threshold(rows: Sequence[tuple[str, str, int]] = tuple(LABELLED), folds: int = 5) -> tuple[float, float, float]:
    """The threshold, a multiple of 0.05, with the least mean of both error rates over hosts the fit has not seen, and the rates.

    The rates are those of urls to be blocked that are missed, and of others that are blocked. Of equal thresholds, the one
    in the middle.
    """
    sites = sorted({site_of(h) for h, _, _ in rows})
    scores = []
    for k in range(folds):
        out = set(sites[k::folds])
        model = UrlModel().fit([r for r in rows if site_of(r[0]) not in out])
        scores += [(model.score(h, p), y) for h, p, y in rows if site_of(h) in out]
    score, label = np.array(scores).T
    rates = [(float(np.mean(score[label == 1] < t)), float(np.mean(score[label == 0] >= t)), t) for t in np.arange(1, 20) / 20]
    least = min(a + b for a, b, _ in rates)
    best = [r for r in rates if r[0] + r[1] <= least + 1e-12]
    missed, blocked, t = best[(len(best) - 1) // 2]
    return float(t), missed, blocked


def judge(
    pages: DataFrame, labelled: Sequence[tuple[str, str, int]] = tuple(LABELLED), rules=RULES,
    id_col: str = "page_id", url_col: str = "url", threshold: float = THRESHOLD,
) -> DataFrame:
    """``(id, host, path, rule, verdict, score)`` per row; a rule decides where one fits, else the model.

    ``labelled`` is a small table of ``(host, path, label)``, MAX_LABELLED rows at most, fitted in one place
    and sent to the tasks. Null urls, and urls without ``://``, have an empty host and path and are judged
    by the intercept's side alone. Rows that repeat an id or url are each returned. An empty table gives
    no rows. Other columns are not read.
    """
    spark = pages.sparkSession
    bounded_batches(spark, 10_000)
    shared = spark.sparkContext.broadcast(UrlModel().fit(list(labelled)))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for host, path in batches:
            yield pd.Series([shared.value.score(h, p) for h, p in zip(host, path)], dtype="float64")

    parts = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    scored = parts.withColumns({"rule": name, "_verdict": verdict, "score": score("host", "path")})
    learned = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(id_col, "host", "path", "rule", F.coalesce("_verdict", learned).alias("verdict"), "score")
