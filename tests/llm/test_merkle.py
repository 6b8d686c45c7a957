"""Manifests against trees built in one piece."""

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.llm import merkle
from kinfold.llm.common import ascii_lower

DOC = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("text", T.StringType()), T.StructField("g", T.StringType()),
    T.StructField("pos", T.LongType()), T.StructField("root", T.StringType()), T.StructField("digest", T.StringType()),
])


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row):
    return H("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in merkle.FIELDS))


def tree_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, i):
    for nodes in levels[:-1]:
        first = i // 8 * 8
        yield "".join(nodes[first:i]), "".join(nodes[i + 1 : first + 8])
        i //= 8


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    trees = {g: tree_of([leaf_of(r) for r in groups[g]]) for g in names}
    crown = tree_of([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            way = [*siblings(trees[g], i), *siblings(crown, at)]
            new = dict(r)
            if r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                new["text"] = re.sub("[A-Z]", lambda m: m[0].lower(), r["text"])
            fold = leaf_of(new)
            for a, b in way:
                fold = H(a + fold + b)
            root = crown[-1][0]
            out.append((r["doc_id"], leaf_of(r), trees[g][-1][0], root, H("".join(a + b for a, b in way)), fold, fold == root))
    return sorted(out, key=repr)


def manifest(rows):
    when = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.manifest(rows, replaced={"text": ascii_lower(F.col("text"))}, when=when)


def same(rows):
    got = manifest(rows)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain([r.asDict() for r in rows.collect()])


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 5, "y", "z") for r in rows], DOC).repartition(3)


def test_awkward_rows(spark):
    same(table(spark, [
        (1, "s", "en", 3, "Abc"), (2, None, None, None, None), (3, "s", None, 0, ""), (3, "s", None, 0, ""), (None, "s", "en", 1, "É"),
        (4, "", "fr", 9, "A" * 200_000), (5, "s", "", 1, "-"), (None, None, None, None, None), (12, "s", "en", 3, "plain"), (-7, "ü", "en", 3, "ABC"),
    ]))


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65, 513, 1100])
def test_whole_and_broken_runs(spark, n):
    same(table(spark, [(i * 7 % 4099, "s", "en", i, f"Text {i}") for i in range(n)]))


def test_more_groups_than_a_run(spark):
    same(table(spark, [(i, "s", f"l{i % 75}", i, f"Text {i}") for i in range(200)]))


def test_no_rows(spark):
    assert manifest(table(spark, [(1, "s", "en", 3, "Abc")]).limit(0)).count() == 0


def test_given_documents(spark, sf):
    same(spark.read.parquet(f"{sf}/documents.parquet"))


def test_folding_resumes_a_kept_state():
    kids = [H(str(i)).encode() for i in range(8)]
    p = merkle.Parent.of(kids)
    for slot in range(8):
        changed = [*kids[:slot], H("new").encode(), *kids[slot + 1 :]]
        assert p.with_child(slot, changed[slot]) == merkle.Parent.of(changed).digest
        assert p.with_child(slot, kids[slot]) == p.digest
