"""Secret scans: fixed patterns, and a randomness test battery with length-aware false-discovery control."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .common import bounded_batches, text_of

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
SHORTEST = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Encodings from the narrowest alphabet to the widest; a token has the first that holds it.
ENCODINGS = {
    "digits": _DIGITS,
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "lower": _LOWER,
    "upper": _UPPER,
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "letters": _UPPER + _LOWER,
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
    "any": _UPPER + _LOWER + _DIGITS + "+/-_",
}
_SETS = {name: frozenset(chars) for name, chars in ENCODINGS.items()}
_INDEX = {name: {c: i for i, c in enumerate(chars)} for name, chars in ENCODINGS.items()}
SYMBOLS = ENCODINGS["any"]
_CODES = np.array([ord(c) for c in SYMBOLS])
# -log10 of the p-values is counted in bins of this width, up to the last bin.
BIN, BINS = 0.02, 2000


@dataclass(frozen=True)
class Settings:
    """``alpha``: a token whose battery rejects randomness at this level is not random.
    ``fdr``: share of ordinary strings accepted among all tokens that are reported."""

    alpha: float = 1e-3
    fdr: float = 0.01


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _lower_tail(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def encoding_of(token: str) -> str:
    """The narrowest alphabet that holds the token, padding aside."""
    used = set(token.rstrip("="))
    return next((n for n, chars in _SETS.items() if used <= chars), "any")


def battery(token: str) -> tuple[str, int, float, float]:
    """``(encoding, length, chi2, p)``; ``p`` combines three tests that the token is uniform and independent.

    The chi-squared statistic of the alphabet's counts, the number of runs above and below the
    alphabet's middle, and the correlation of neighbours, each as a p-value; Fisher's sum combines them.
    """
    name = encoding_of(token)
    index = _INDEX[name]
    v = np.array([index[c] for c in token if c in index], dtype=np.int64)
    n, size = len(v), len(index)
    if n < 2:
        return name, n, 0.0, 0.0
    counts = np.bincount(v, minlength=size)
    chi2 = float((counts.astype(float) ** 2).sum() * size / n - n)
    # mean and spread of the statistic are exact for short tokens too
    p1 = 1 - _lower_tail((chi2 - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n))
    high = v >= size / 2
    a, b = int(high.sum()), int(n - high.sum())
    if a and b and n > 2:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * a * b / n
        spread = (mean - 1) * (mean - 2) / (n - 1)
        p2 = _two_sided((runs - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        p2 = 2.0 ** (1 - n)
    x = v - v.mean()
    var = float((x * x).sum())
    p3 = _two_sided(float((x[1:] * x[:-1]).sum()) / var * math.sqrt(n)) if var else 0.0
    half = -sum(math.log(max(p, 1e-300)) for p in (p1, p2, p3))
    return name, n, chi2, math.exp(-half) * (1 + half + half * half / 2)


def base_spans(text: str, candidates: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, sorted. Hex runs lie inside candidate runs."""
    out = []
    low = text.lower() if (":" in text or "=" in text) else ""
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    for a, b in candidates:
        if b - a >= 24:
            out += [(m.start(), 2, m.end()) for m in HEX.finditer(text, a, b) if m.end() - m.start() >= 24]
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def outside(candidates: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Candidates that no span holds whole, in one walk: both lists are sorted by their starts.

    Of the spans that start at or before a candidate, the one that reaches farthest decides.
    """
    out, at, reach = [], 0, -1
    for a, b in candidates:
        while at < len(spans) and spans[at][0] <= a:
            reach = max(reach, spans[at][2])
            at += 1
        if reach < b:
            out.append((a, b))
    return out


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        seen = np.zeros(128, dtype=np.int64)
        base, n, tokens = [], [], []
        for text in rows["text"]:
            raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
            seen += np.bincount(raw[raw < 128], minlength=128)
            found = [m.span() for m in CANDIDATE.finditer(text)]
            if found:  # ordinary text is what lies outside of the tokens under test
                inside = "".join(text[a:b] for a, b in found).encode("ascii")
                seen -= np.bincount(np.frombuffer(inside, dtype=np.uint8), minlength=128)
            spans = base_spans(text, found)
            base.append(joined(spans))
            n.append([sum(k == kind for _, k, _ in spans) for kind in range(3)])
            tokens.append([(a, b, *battery(text[a:b])) for a, b in outside(found, spans)])
        out = pd.DataFrame({"id": rows["id"], "base": base, "n": n, "tokens": tokens})
        out["counts"] = [seen[_CODES].tolist(), *[None] * (len(rows) - 1)] if len(rows) else []
        yield out


def ordinary_excess(counts: dict[str, int]) -> dict[str, float]:
    """Per encoding, how far ordinary text is from uniform: ``size * sum(share^2) - 1`` over the alphabet."""
    out = {}
    for name, chars in ENCODINGS.items():
        total = sum(counts.get(c, 0) for c in chars)
        share = sum((counts.get(c, 0) / total) ** 2 for c in chars) if total else 1.0
        out[name] = max(len(chars) * share - 1, 1e-3)
    return out


def evidence(encoding: str, n: int, chi2: float, excess: dict[str, float]) -> float:
    """-log10 of the chance that ordinary text of this length and alphabet is as even as the token.

    For ordinary text the statistic grows with the length, so a short token carries little evidence.
    """
    size, d = len(ENCODINGS[encoding]), excess[encoding]
    mean, var = size - 1 + (n - 1) * d, 2 * (size - 1) + 4 * (n - 1) * d
    p = _lower_tail((chi2 - mean) / math.sqrt(var))
    return -math.log10(max(p, 1e-40))


def fdr_bin(histogram: dict[int, int], fdr: float) -> int:
    """Lowest bin such that what lies in it and above passes the Benjamini-Hochberg step-up rule."""
    total, above, best = sum(histogram.values()), 0, BINS + 1
    for b in sorted(histogram, reverse=True):
        above += histogram[b]
        if 10 ** (-b * BIN) <= fdr * above / total:  # the lower edge of a bin is its largest p-value
            best = b
    return best


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``id, n_assign, n_access, n_hex, base_sha256, spans, n_random``.

    Spans are in characters, end exclusive: those of the fixed patterns, and ``random`` ones for runs of
    20 or more token characters outside them that (a) pass the battery for their inferred encoding and
    (b) are more even than ordinary text of their length can be: p-values against the character
    frequencies of all documents outside such runs, with the Benjamini-Hochberg rule over all tokens of all documents.
    Only the character counts and the histogram of p-values (both of fixed size) reach the driver.

    Null text is empty text, without spans (the hash is that of the empty string). Rows that repeat an
    id or a text are each returned, and count each in the statistics. Work grows with a text's length, however many
    tokens it holds. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    token = "array<struct<a:long,b:long,enc:string,n:long,chi2:double,p:double>>"
    schema = f"id {kind}, base string, n array<long>, tokens {token}, counts array<long>"
    found = checkpoint(rows.mapInPandas(_scan, schema))
    sums = found.where("counts IS NOT NULL").agg(*[F.sum(F.col("counts")[i]).alias(f"c{i}") for i in range(len(SYMBOLS))])
    excess = ordinary_excess({c: x or 0 for c, x in zip(SYMBOLS, sums.first())})

    @F.pandas_udf("long")
    def bin_of(enc: pd.Series, n: pd.Series, chi2: pd.Series) -> pd.Series:
        return pd.Series([min(BINS, int(evidence(e, k, c, excess) / BIN)) for e, k, c in zip(enc, n, chi2)], dtype="int64")

    tokens = found.where(F.size("tokens") > 0).select(F.explode("tokens").alias("t"))
    weighed = tokens.select(bin_of("t.enc", "t.n", "t.chi2").alias("bin"))
    histogram = {r["bin"]: r["count"] for r in weighed.groupBy("bin").count().collect()}  # at most BINS + 1 rows
    lowest = fdr_bin(histogram, settings.fdr)
    alpha = settings.alpha

    @F.pandas_udf("n_random long, base_sha256 string, spans string")
    def finish(base: pd.Series, tokens: pd.Series) -> pd.DataFrame:
        out = []
        for b, more in zip(base, tokens):
            spans = [(int(a), KINDS.index(k), int(e)) for k, a, e in (x.split(":") for x in b.split(",") if x)]
            new = [
                (t["a"], 3, t["b"]) for t in more
                if t["p"] >= alpha and min(BINS, int(evidence(t["enc"], t["n"], t["chi2"], excess) / BIN)) >= lowest
            ]
            out.append((len(new), hashlib.sha256(b.encode()).hexdigest(), joined(sorted(spans + new))))
        return pd.DataFrame(out, columns=["n_random", "base_sha256", "spans"])

    done = found.withColumn("f", finish("base", "tokens"))
    return done.select(
        F.col("id").alias(id_col), F.col("n")[0].alias("n_assign"), F.col("n")[1].alias("n_access"),
        F.col("n")[2].alias("n_hex"), "f.base_sha256", "f.spans", "f.n_random",
    )
