"""Queries over the given tables, one per operator, and their SQL counterparts where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare_session
from . import bpe, collocations, embedding_dedup, exact_dedup, html_wrappers, license_scan, merkle, mixing, one_bit_search, secrets
from . import simhash_dedup, toxicity, url_filter
from .common import ascii_lower, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RANKS = "byte_bpe_50k.tiktoken"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare_session(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@query
def op3_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extract(table(spark, sf_dir, "pages"))


@query
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents"), keep="largest")


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query
def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), replaced={"text": ascii_lower(F.col("text"))}, when=tampered)


@query
def op13_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_bit_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def _merkle_sql(levels: int = 8) -> str:
    """Level by level; a group that is down to one node stays as it is."""
    leaf = "sha256({})".format(" || ".join(
        f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}::VARCHAR) || ':' || {v}::VARCHAR END" for v in ("doc_id", "source", "lang", "n_chars", "{text}")
    ))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, ch), range(8)), lambda c, i: {step})"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), lambda c, ch: {byte}), 4294967295)"
    sql = [f"""WITH d AS (
        SELECT doc_id, coalesce('1' || lang, '0') AS g, {leaf.format(text='text')} AS leaf, {leaf.format(text=lower)} AS other, {crc} % 3 = 0 AS hit
        FROM documents),
    a0 AS (SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY g) AS n, leaf AS h, doc_id FROM d)"""]

    def tree(name: str) -> None:
        for k in range(levels):
            around = "OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN"
            sql.append(f"""{name}s{k} AS (SELECT g, i, n,
                coalesce(string_agg(h, '') {around} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(h, '') {around} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
            sql.append(f"""{name}{k + 1} AS (SELECT g, i // 8 AS i, (max(n) + 7) // 8 AS n,
                CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} GROUP BY g, i // 8)""")

    def fold(name: str, start: str, tops: str) -> None:
        last = start
        for k in range(levels):
            sql.append(f"""{tops}{k} AS (SELECT {tops}_p.doc_id, {tops}_p.g, {tops}_p.i // 8 AS i,
                CASE WHEN s.n = 1 THEN fold ELSE sha256(s.l || fold || s.r) END AS fold, CASE WHEN s.n = 1 THEN proof ELSE proof || s.l || s.r END AS proof
                FROM {last} AS {tops}_p JOIN {name}s{k} AS s ON s.g = {tops}_p.g AND s.i = {tops}_p.i)""")
            last = f"{tops}{k}"

    tree("a")
    sql.append(f"b0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n, h, g AS name FROM a{levels})")
    tree("b")
    sql.append("f AS (SELECT d.doc_id, a0.g, a0.i, CASE WHEN hit THEN other ELSE leaf END AS fold, '' AS proof FROM d JOIN a0 ON d.doc_id = a0.doc_id)")
    fold("a", "f", "fa")
    sql.append(f"t AS (SELECT doc_id, 0 AS g, b0.i, fold, proof FROM fa{levels - 1} AS x JOIN b0 ON b0.name = x.g)")
    fold("b", "t", "fb")
    return ",\n".join(sql) + f"""
        SELECT d.doc_id, d.leaf, b0.h AS subroot, z.h AS root, sha256(x.proof) AS proof_sha256, x.fold AS folded_root, x.fold = z.h AS verified
        FROM d JOIN b0 ON b0.name = d.g JOIN fb{levels - 1} AS x ON x.doc_id = d.doc_id CROSS JOIN b{levels} AS z"""


ORACLE: dict[str, str] = {
    "op11_collocations": r"""
        WITH t AS (
            SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
        ),
        p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM t),
        w AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
        words AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
        g AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 4) AS s(k)),
        f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
        c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
        cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
        s AS (
            SELECT cuts.lang, cuts.phrase, a, cut, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
            FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.w[:cut], ' ')
            JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.w[cut + 1:], ' ')
        ),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        inside AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE k = 3),
        m AS (SELECT lang, phrase, max(a) AS longer FROM inside GROUP BY lang, phrase),
        k AS (SELECT b.* FROM b LEFT JOIN m USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * b.a),
        r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k)
        SELECT r.lang, rank, phrase, a, l, r.r, n, score::BIGINT AS score FROM r JOIN words USING (lang) WHERE rank <= 2000""",
    "op12_merkle_manifest": _merkle_sql(),
    # the search may miss a vector beyond its error bounds; on the given tables it misses none
    "op13_one_bit_search": """
        WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        d AS (SELECT a.vec_id AS query_id, b.vec_id, sqrt(list_reduce(
            list_prepend(0.0::DOUBLE, list_transform(list_zip(a.e, b.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), lambda s, x: s + x)) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM d)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op4_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
        r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
        SELECT vec_id, coalesce(n.n, 0) AS n_links, c.c AS component_id, vec_id = c.c AS kept
        FROM v JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a""",
    "op5_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
        )
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY t)""",
    # rates stay below 16 here, so that each document needs one draw
    "op8_mix_sources": """
        WITH s AS (SELECT source, sum(coalesce(length(text), 0) + 1)::DOUBLE AS size FROM documents GROUP BY source),
        t AS (SELECT sum(size) AS n, sum(pow(size, 0.5)) AS w FROM s),
        r AS (SELECT source, round(pow(size, 0.5) / w * n / size, 10) AS rate FROM s, t),
        k AS (SELECT source, i, exp(-rate + i * ln(rate) - lgamma(i + 1)) AS p FROM r, range(60) AS x(i)),
        c AS (SELECT source, i, sum(p) OVER (PARTITION BY source ORDER BY i) AS c FROM k),
        d AS (SELECT *, ('0x' || substr(md5('17|' || doc_id || '|1'), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents),
        m AS (SELECT d.*, (SELECT count(*) FROM c WHERE c.source = d.source AND c.c <= d.u) AS copies FROM d)
        SELECT doc_id, text, lang, source, n_chars, j::INTEGER AS mix_copy,
            ('0x' || substr(md5('18|' || doc_id || '|' || j), 1, 13))::BIGINT AS mix_key
        FROM m, LATERAL (SELECT unnest(range(1, copies + 1)) AS j)""",
}
