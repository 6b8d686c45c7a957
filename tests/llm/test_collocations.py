"""Phrases against a plain count, with whole and with cut fingerprints, and on awkward rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from kinfold.llm import collocations as c

DOC = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("part", T.StringType()), T.StructField("key", T.StringType()), T.StructField("phrase", T.StringType()),
    T.StructField("n", T.LongType()), T.StructField("kind", T.StringType()),
])


def pieces(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", text)]


def plain(rows, min_count, top, longest=3):
    total, counts = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = lang or "und"
        for w in pieces(text):
            total[lang] += len(w)
            counts[lang].update(tuple(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        gone = {
            p[i : i + m] for p, a in good.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
            if 100 * a >= 50 * good[p[i : i + m]]
        }
        scored = []
        for p, a in good.items():
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], p))
        ranked = sorted(s for s in scored if s[-1] not in gone)[:top]
        out += [(lang, r, s[2].decode(), -s[1], s[3], s[4], total[lang], -s[0]) for r, s in enumerate(ranked, 1)]
    return sorted(out)


def awkward(spark):
    texts = [
        (1, None, "a"), (2, "", None), (3, " \t\n.;", "a"), (4, "One two  three\tFOUR five. one two three four!", "a"),
        (5, "one two three one two three, éa ÉA éa", None), (5, "one two three one two three, éa ÉA éa", None),
        (None, "one two three", "a"), (None, "one two three", "b"), (6, "x" * 70_000 + " y " + "x" * 70_000 + " y", "a"),
        (7, "word " * 30_000, "b"), (8, "a b " * 20 + "a c", "b"), (9, "one two:three one;two three", "und"),
    ]
    return spark.createDataFrame([(i, t, l, "x", "y", "z", 1, "t") for i, t, l in texts], DOC).repartition(3)


@pytest.mark.parametrize("bits,chunk", [(64, 1 << 20), (9, 200), (1, 1 << 20)])
def test_equals_a_plain_count_whatever_the_fingerprints(spark, bits, chunk):
    rows = awkward(spark)
    got = c.mine(rows, min_count=2, bits=bits, chunk_bytes=chunk)
    expected = plain([(r["lang"], r["text"]) for r in rows.collect()], 2, 2000)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_longer_phrases_and_a_short_list(spark):
    rows = awkward(spark)
    got = c.mine(rows, max_words=4, min_count=3, top=2)
    assert sorted(tuple(r) for r in got.collect()) == plain([(r["lang"], r["text"]) for r in rows.collect()], 3, 2, longest=4)


def test_given_documents(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    got = sorted(tuple(r) for r in c.mine(rows, min_count=5).collect())
    assert got == plain([(r["lang"], r["text"]) for r in rows.collect()], 5, 2000)


def test_products_beyond_64_bits(spark):
    """Counts of this size do not occur here, so the score is taken from a made-up table of counts."""
    a, l, r = 3_000_000_000, 4_000_000_001, 5_000_000_003
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").selectExpr("a", "l", "r").withColumns(
        {"_up": c._exact("a") * c._exact("a") * 1_000_000, "_down": c._exact("l") * c._exact("r")}
    ).selectExpr("_up div _down AS score").first()
    assert row["score"] == 1_000_000 * a * a // (l * r)


def test_no_rows(spark):
    assert c.mine(awkward(spark).limit(0)).count() == 0


def words(*texts):
    data, offsets = c._bytes_of(pa.array(texts, pa.string()))
    return c.Words.of(data, offsets, np.zeros(len(texts), np.uint64))


def test_hashes_do_not_depend_on_place_or_blanks():
    w = words("zz. the  cat\tsat", "", "The cat sat")
    at = w.runs(3)
    h = w.fingerprints(at, 3)
    assert len(h) == 2 and h[0] == h[1]
    assert w.same(at[:1], at[1:], 3).all()
    assert w.phrases(at, np.array([3, 3])).to_pylist() == ["the cat sat"] * 2
    v = words("the cat sot", "the cat sat")
    assert not v.same(v.runs(3)[:1], v.runs(3)[1:], 3).any()


def test_words_longer_than_a_polynomial():
    long = "q" * (c.SLICE + 5000)
    w = words(f"a {long} b", f"{long} b")
    h = w.fingerprints(w.runs(2), 2)
    assert h[1] == h[2] and h[0] != h[1]


def test_filter_holds_nothing_back():
    fp = np.sort(np.random.default_rng(0).integers(0, 1 << 64, 5000, dtype=np.uint64))
    stretches = {}
    for b, part in c._split((fp >> np.uint64(60)).astype(np.int64), 16):
        stretches[b] = c.Filter.stretch(fp[part], 1 << 12)
    f = c.Filter.of(stretches, 16)
    assert f.passes(fp).all()
    assert f.passes(np.random.default_rng(1).integers(0, 1 << 64, 5000, dtype=np.uint64)).mean() < 0.2


def test_packing_returns_what_went_in():
    x, y = np.array([1, 5, 1 << 63], np.uint64), np.array([7, 0, 65535], "<u2")
    size, body = c._pack(x, y)
    a, b = c._unpack(body, size, ["<u8", "<u2"])
    assert a.tolist() == x.tolist() and b.tolist() == y.tolist()
