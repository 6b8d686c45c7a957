"""The catalogue's queries in plain SQL, for an independent engine to check against."""

from __future__ import annotations

from .catalog import KS, RULES, STEPS
from .views import FEATURES, LINE_FEATURES, SQL_COPIES, SQL_EMB, SQL_FEAT, SQL_LINES, SQL_SUPPLIERS, SQL_TXN, sql_u01

ORACLE: dict[str, str] = {}


def add(name: str, sql: str) -> None:
    ORACLE[name] = sql


def r(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0"


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


# --- flagship ---------------------------------------------------------------------------------

_SCALED = SQL_FEAT + """,
  par AS (SELECT avg(log_amount) AS m, stddev_pop(log_amount) AS s,
    quantile_cont(time_sin, 0.5) AS sm, quantile_cont(time_sin, 0.75) - quantile_cont(time_sin, 0.25) AS ss,
    quantile_cont(time_cos, 0.5) AS cm, quantile_cont(time_cos, 0.75) - quantile_cont(time_cos, 0.25) AS cs FROM feat),
  sc AS (SELECT row_id, grp, rare AS y, (log_amount - m) / s AS a, (time_sin - sm) / ss AS b, (time_cos - cm) / cs AS c FROM feat, par),
  cen AS (SELECT grp, avg(a) AS ca, avg(b) AS cb, avg(c) AS cc FROM sc GROUP BY grp),
  scored AS (SELECT row_id, y, sqrt((a-ca)*(a-ca) + (b-cb)*(b-cb) + (c-cc)*(c-cc)) AS distance FROM sc JOIN cen USING (grp)),
  flagged AS (SELECT *, row_number() OVER (ORDER BY distance DESC, row_id) <= greatest(1, round_even(0.01 * (SELECT count(*) FROM scored), 0)) AS hit FROM scored)"""
_RANKS = """,
  cnt AS (SELECT {g} s, sum(y) AS pos, sum(1 - y) AS neg FROM {src} GROUP BY {g} s),
  cum AS (SELECT *, sum(pos) OVER ({p} ORDER BY s DESC) AS cp, sum(neg) OVER ({p} ORDER BY s DESC) AS cn FROM cnt),
  rk AS (SELECT {g} sum(neg * (cp - pos / 2.0)) / (sum(pos) * sum(neg)) AS roc_auc, sum(pos * cp / (cp + cn)) / sum(pos) AS average_precision FROM cum {gb})"""


def ranks(src: str, group: str = "") -> str:
    g = f"{group}," if group else ""
    return _RANKS.format(g=g, src=src, p=f"PARTITION BY {group}" if group else "", gb=f"GROUP BY {group}" if group else "")


add("anomaly_scoreboard", f"""WITH {_SCALED}, src AS (SELECT y, distance AS s FROM scored){ranks("src")}
SELECT count(*) AS n_points, count(*) FILTER (hit) AS n_flagged, 0.01::DOUBLE AS top_fraction,
  {r("avg(y) FILTER (hit)")} AS precision_at_k, {r("sum(y) FILTER (hit) / sum(y)::DOUBLE")} AS recall_at_k,
  {r("avg(y)")} AS base_rate, {r("avg(y) FILTER (hit) / avg(y)")} AS enrichment,
  {r("(SELECT roc_auc FROM rk)")} AS roc_auc, {r("(SELECT average_precision FROM rk)")} AS average_precision FROM flagged""")
add("anomaly_ranking", f"WITH {_SCALED} SELECT row_id, y AS class, {r('distance')} AS distance FROM flagged WHERE hit")

# --- sources and contracts ---------------------------------------------------------------------

_rules = [("coercible", "amount", "false"), ("coercible", "k", "false"), ("coercible", "grp", "false"),
          ("not_null", "amount", "amount IS NULL"), ("not_null", "k", "k IS NULL"), ("not_null", "grp", "grp IS NULL"),
          ("min", "amount", "amount < 1.0"), ("in_range", "k", "k < 0 OR k > 90"), ("isin", "grp", "grp NOT IN ('click', 'error')")]
add("schema_violations", f"WITH {SQL_TXN} " + union(
    [f"SELECT '{k}' AS rule, '{c}' AS \"column\", count(*) FILTER ({t}) AS violations FROM txn" for k, c, t in _rules]
    + ["SELECT 'missing', 'gone', 1::BIGINT", "SELECT 'unexpected', 'class', 1::BIGINT"]))
add("source_expectations", """SELECT 'rows' AS "check", '15000' AS expected, count(*)::VARCHAR AS actual, count(*) = 15000 AS passed FROM orders
UNION ALL SELECT 'columns', '7', count(*)::VARCHAR, count(*) = 7 FROM (DESCRIBE orders)""")
add("table_fingerprint", """SELECT count(*) AS row_count, sum(CAST('0x' || substr(md5(concat_ws('|', o_orderkey::VARCHAR, o_custkey::VARCHAR,
  coalesce(o_orderstatus, ''), coalesce(o_orderpriority, ''))), 1, 8) AS BIGINT))::VARCHAR AS hash_total FROM orders""")
add("csv_ingest", f"SELECT o_orderstatus, count(*) AS n, {r('sum(o_totalprice)', 2)} AS total FROM orders GROUP BY 1")
add("label_store", f"WITH {SQL_TXN} SELECT CAST(k // 10 AS INTEGER) AS cluster, count(*) AS size FROM txn GROUP BY 1")
add("json_summary", f"""WITH {SQL_TXN} SELECT '{{"grp":"' || grp || '","n":' || count(*) || ',"top":' || max(k) || ',"score":null}}' AS json FROM txn GROUP BY grp""")

# --- projections, filters, distances ------------------------------------------------------------

add("engineered_features", f"WITH {SQL_FEAT} SELECT row_id, " + ", ".join(f"{r(c)} AS {c}" for c in FEATURES[:3]) + " FROM feat")
add("cyclic_phase", f"WITH {SQL_FEAT} SELECT row_id, {r('atan2(time_sin, time_cos)', 5)} AS phase FROM feat")
add("isolated_labels", f"WITH {SQL_TXN} SELECT row_id, class FROM txn")
add("chosen_clusters", f"WITH {SQL_FEAT} SELECT row_id, grp, rare FROM feat WHERE grp IN ('error', 'click') AND rare = 1")
_MAN = "list_sum(list_transform(list_zip({a}, {b}), lambda z: abs(z[1] - z[2])))"
add("distance_metrics", f"""WITH {SQL_EMB} SELECT row_id, {r("list_distance(f, c)")} AS euclidean,
  {r(_MAN.format(a="f", b="c"))} AS manhattan, {r("list_cosine_distance(f, c)")} AS cosine FROM emb JOIN cen USING (cluster)""")
add("mahalanobis", f"""WITH {SQL_LINES}, m AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my, var_samp(l_quantity) AS a,
  var_samp(l_extendedprice) AS d, covar_samp(l_quantity, l_extendedprice) AS b FROM li),
  q AS (SELECT l_returnflag, sqrt(((l_quantity-mx)*(l_quantity-mx)*d - 2*b*(l_quantity-mx)*(l_extendedprice-my)
  + (l_extendedprice-my)*(l_extendedprice-my)*a) / (a*d - b*b)) AS dist FROM li, m)
SELECT l_returnflag, {r("avg(dist)")} AS mean_distance, {r("max(dist)")} AS max_distance FROM q GROUP BY 1""")
add("covariance", f"WITH {SQL_LINES} " + union(
    [f"SELECT {i} AS i, {j} AS j, {r(f'covar_samp({LINE_FEATURES[i]}, {LINE_FEATURES[j]})', 3)} AS cov FROM li"
     for i in range(4) for j in range(i, 4)]))

# --- duplicates, sets, samples --------------------------------------------------------------------

add("dedupe_rows", f"WITH {SQL_COPIES} SELECT min(row_id) AS row_id, o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM copies GROUP BY ALL")
add("dedupe_stats", f"""WITH {SQL_COPIES}, d AS (SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM copies)
SELECT (SELECT count(*) FROM copies) AS input_rows, (SELECT count(*) FROM copies) - count(*) AS dropped_rows, count(*) AS output_rows,
  count(*) FILTER (o_orderstatus = 'F') AS positive_rows, count(*) FILTER (o_orderstatus <> 'F') AS negative_rows FROM d""")
add("label_counts", f"WITH {SQL_EMB} SELECT CASE WHEN cluster = 0 THEN -1 ELSE cluster END AS cluster, count(*) AS size FROM emb GROUP BY 1")
_ORD = "o AS (SELECT o_orderkey AS row_id, o_orderstatus AS class FROM orders)"


def _ranked(tag: str, seed: int, by: str = "PARTITION BY class") -> str:
    u = sql_u01("row_id", tag, seed)
    return f"""{_ORD}, rk AS (SELECT *, row_number() OVER ({by} ORDER BY {u}, row_id) AS rn, count(*) OVER (PARTITION BY class) AS c,
  count(*) OVER () AS t FROM o)"""


add("strat_sample", f"WITH {_ranked('strat', 3)} SELECT row_id, class FROM rk WHERE rn <= least(c, greatest(1, round_even(700.0 * c / t, 0)))")
add("simple_sample", f"WITH {_ranked('simple', 4, '')} SELECT row_id, class FROM rk WHERE rn <= 500")
add("quota_sample", f"WITH {_ranked('quota', 5)} SELECT row_id, class FROM rk WHERE (class = 'F' AND rn <= 300) OR (class = 'P' AND rn <= 40)")
add("sample_union", f"WITH {_ranked('quota', 6)} SELECT row_id, class FROM rk WHERE class IN ('F', 'O') AND rn <= 100")
add("strat_split", f"WITH {_ranked('split', 7)} SELECT row_id, class, rn <= round_even(0.3 * c, 0) AS is_test FROM rk")


def _draws(seed: int, frac: float) -> str:
    u = sql_u01("(replicate || '-' || draw)", "boot", seed)
    return f"""{_ORD}, pos AS (SELECT row_id, class, row_number() OVER (ORDER BY row_id) - 1 AS position FROM o), n AS (SELECT count(*) AS n FROM o),
  dr AS (SELECT a.range AS replicate, b.range AS draw FROM range(2) a, range((SELECT CAST(floor(n * {frac}) AS BIGINT) FROM n)) b),
  boot AS (SELECT replicate, row_id, class, count(*) AS multiplicity FROM (SELECT replicate, CAST(floor({u} * (SELECT n FROM n)) AS BIGINT) AS position FROM dr)
    JOIN pos USING (position) GROUP BY ALL)"""


add("bootstrap_rows", f"WITH {_draws(8, 0.5)} SELECT replicate, row_id, multiplicity FROM boot")
add("common_draws", f"""WITH {_draws(9, 0.4)} SELECT row_id, a.class AS cluster_a, b.class AS cluster_b FROM boot a JOIN boot b USING (row_id)
WHERE a.replicate = 0 AND b.replicate = 1""")
add("temporal_split", """SELECT row_id, CASE WHEN rn <= floor(t * 0.4) THEN 'early' ELSE 'late' END AS half FROM (SELECT o_orderkey AS row_id,
  row_number() OVER (ORDER BY epoch_us(o_orderdate), o_orderkey) AS rn, count(*) OVER () AS t FROM orders)""")
add("top_per_group", """SELECT * FROM (SELECT o_orderpriority, o_orderkey, o_totalprice, CAST(row_number() OVER (PARTITION BY o_orderpriority
  ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders) WHERE rank <= 10""")

# --- joins and neighbours -------------------------------------------------------------------------

add("aligned_rows", f"WITH {SQL_FEAT} SELECT class, count(*) AS n, {r('avg(log_amount)')} AS mean_amount FROM feat GROUP BY 1")
add("nearest_centroid", f"""WITH {SQL_EMB}, p AS (SELECT row_id, cen.cluster AS k, list_distance(f, c) AS d FROM emb, cen)
SELECT row_id, arg_min(k, d) AS assigned_cluster, {r("min(d)")} AS distance_to_centroid FROM p GROUP BY row_id""")
add("centroid_rank", f"""WITH {SQL_EMB}, p AS (SELECT row_id, cen.cluster AS k, list_distance(f, c) AS d FROM emb, cen)
SELECT row_id, k AS cluster, {r("d")} AS distance, CAST(row_number() OVER (PARTITION BY row_id ORDER BY d, k) AS INTEGER) AS rank FROM p""")
add("centroids", f"""WITH {SQL_EMB} SELECT cluster, count(*) AS size, i AS dim, {r("avg(x)")} AS value FROM dims GROUP BY cluster, i""")
_PAIRS = f"""{SQL_EMB}, p AS (SELECT least(a.cluster, b.cluster) AS cluster_a, greatest(a.cluster, b.cluster) AS cluster_b,
  list_distance(a.f, b.f) AS d, a.f AS fa, b.f AS fb FROM emb a JOIN emb b ON a.row_id < b.row_id)"""
add("pairwise_distance", f"""WITH {_PAIRS} SELECT cluster_a, cluster_b, count(*) AS pairs, {r("avg(d)")} AS mean, {r("min(d)")} AS nearest,
  {r("max(d)")} AS farthest FROM p GROUP BY 1, 2""")
add("pairwise_manhattan", f"""WITH {_PAIRS} SELECT cluster_a, cluster_b, count(*) AS pairs, {r(f"avg({_MAN.format(a='fa', b='fb')})")} AS mean FROM p GROUP BY 1, 2""")
add("knn", f"""WITH {SQL_EMB} SELECT row_id, neighbour, {r("d")} AS distance, CAST(rank AS INTEGER) AS rank FROM (SELECT a.row_id, b.row_id AS neighbour,
  list_distance(a.f, b.f) AS d, row_number() OVER (PARTITION BY a.row_id ORDER BY list_distance(a.f, b.f), b.row_id) AS rank
  FROM emb a JOIN emb b ON a.row_id <> b.row_id) WHERE rank <= 2""")

# --- scaling, reduction, tendency -------------------------------------------------------------------

_IQR = "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"


def _scale(standard: list[str], robust: list[str]) -> str:
    par = [f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in standard]
    par += [f"quantile_cont({c}, 0.5) AS m_{c}, {_IQR.format(c=c)} AS s_{c}" for c in robust]
    cols = [f"({c} - m_{c}) / s_{c} AS {c}" for c in standard + robust]
    return f"par AS (SELECT {', '.join(par)} FROM feat), sc AS (SELECT row_id, {', '.join(cols)} FROM feat, par)"


_ENG = FEATURES[:3]
_STRATEGIES = {"standard": (["k25", *_ENG], []), "robust": ([], ["k25", *_ENG]), "hybrid": (["k25"], _ENG)}
for _name, (_s, _b) in _STRATEGIES.items():
    add(f"scale_{_name}", f"WITH {SQL_FEAT}, {_scale(_s, _b)} SELECT row_id, " + ", ".join(f"{r(c)} AS {c}" for c in ["k25", *_ENG]) + " FROM sc")
add("scaling_compare", union([
    f"(WITH {SQL_FEAT}, {_scale(*v)} SELECT '{n}' AS strategy, {r(_IQR.format(c='log_amount'))} AS amount_iqr, {r('avg(k25)')} AS first_mean, {r('stddev_samp(k25)')} AS first_std FROM sc)"
    for n, v in _STRATEGIES.items()]))
add("total_variance", f"WITH {SQL_EMB} SELECT {r('sum(v)')} AS total FROM (SELECT i, var_samp(x) AS v FROM dims GROUP BY i)")
_box = ", ".join(f"min({c}) AS a{i}, max({c}) AS b{i}" for i, c in enumerate(FEATURES))
_probe = ", ".join(f"a{i} + {sql_u01('id', f'probe{i}', 1)} * (b{i} - a{i})" for i in range(4))
add("hopkins", f"""WITH {SQL_FEAT}, box AS (SELECT {_box} FROM feat),
  n AS (SELECT count(*) AS n, CASE WHEN 300 < count(*) THEN 300 ELSE greatest(2, count(*) // 10) END AS m FROM fv),
  fake AS (SELECT id, [{_probe}] AS g FROM (SELECT range AS id FROM range((SELECT m FROM n))), box),
  real AS (SELECT row_id, f FROM (SELECT row_id, f, row_number() OVER (ORDER BY {sql_u01("row_id", "hopkins", 1)}, row_id) AS rn FROM fv) WHERE rn <= (SELECT m FROM n)),
  u AS (SELECT min(list_distance(g, f)) AS d FROM fake, fv GROUP BY id),
  w AS (SELECT min(list_distance(a.f, b.f)) AS d FROM real a JOIN fv b ON a.row_id <> b.row_id GROUP BY a.row_id)
SELECT {r("(SELECT sum(d*d*d*d) FROM u) / ((SELECT sum(d*d*d*d) FROM u) + (SELECT sum(d*d*d*d) FROM w))")} AS hopkins""")


def _hopkins(src: str, seed: int, tag: str) -> str:
    """CTEs ending in ``h{tag} (h)``: the statistic of ``src (row_id, f)`` with 300 probes."""
    box = ", ".join(f"min(f[{i + 1}]) AS a{i}, max(f[{i + 1}]) AS b{i}" for i in range(4))
    probe = ", ".join(f"a{i} + {sql_u01('id', f'probe{i}', seed)} * (b{i} - a{i})" for i in range(4))
    return f"""box{tag} AS (SELECT {box}, CASE WHEN 300 < count(*) THEN 300 ELSE greatest(2, count(*) // 10) END AS m FROM {src}),
  fake{tag} AS (SELECT id, [{probe}] AS g FROM (SELECT range AS id FROM range((SELECT m FROM box{tag}))), box{tag}),
  real{tag} AS (SELECT row_id, f FROM (SELECT row_id, f, row_number() OVER (ORDER BY {sql_u01("row_id", "hopkins", seed)}, row_id) AS rn FROM {src})
    WHERE rn <= (SELECT m FROM box{tag})),
  u{tag} AS (SELECT min(list_distance(g, f)) AS d FROM fake{tag}, {src} GROUP BY id),
  w{tag} AS (SELECT min(list_distance(a.f, b.f)) AS d FROM real{tag} a JOIN {src} b ON a.row_id <> b.row_id GROUP BY a.row_id),
  h{tag} AS (SELECT (SELECT sum(pow(d, 4)) FROM u{tag}) / ((SELECT sum(pow(d, 4)) FROM u{tag}) + (SELECT sum(pow(d, 4)) FROM w{tag})) AS h)"""


def _repeats(n: int) -> str:
    return "all_h AS (" + union([f"SELECT {i} AS i, h FROM h{i}" for i in range(n)]) + ")"


add("hopkins_repeated", f"""WITH {SQL_FEAT}, {", ".join(_hopkins("fv", i, str(i)) for i in range(3))}, {_repeats(3)}
SELECT 3 AS repeats, {r("avg(h)")} AS mean, {r("stddev_pop(h)")} AS std, 0.6::DOUBLE AS threshold, avg(h) >= 0.6 AS passed,
  list({r("h")} ORDER BY i) AS hopkins_values FROM all_h""")


def _noise(seed: int) -> str:
    cells = ", ".join(f"lo{i} + {sql_u01('id', f'null{i}', seed)} * (hi{i} - lo{i})" for i in range(4))
    return f"noise{seed} AS MATERIALIZED (SELECT id AS row_id, [{cells}] AS f FROM (SELECT range AS id FROM range((SELECT n FROM span))), span)"


_span = "span AS (SELECT count(*) AS n, " + ", ".join(f"min(f[{i + 1}]) AS lo{i}, max(f[{i + 1}]) AS hi{i}" for i in range(4)) + " FROM fv)"
add("hopkins_null", f"""WITH {SQL_FEAT}, {_span}, {", ".join(_noise(i) + ", " + _hopkins(f"noise{i}", i, str(i)) for i in range(2))}, {_repeats(2)}
SELECT CAST(i AS INTEGER) AS repeat, {r("h")} AS hopkins, {r("avg(h) OVER ()")} AS mean, {r("stddev_pop(h) OVER ()")} AS std FROM all_h""")
add("density_grid", f"""WITH {SQL_FEAT}, b AS (SELECT min(log_amount) AS x0, max(log_amount) AS x1, min(time_sin) AS y0, max(time_sin) AS y1 FROM feat)
SELECT CAST(least(floor((log_amount - x0) / (x1 - x0) * 60), 59) AS INTEGER) AS bin_x,
  CAST(least(floor((time_sin - y0) / (y1 - y0) * 60), 59) AS INTEGER) AS bin_y, count(*) AS n FROM feat, b GROUP BY 1, 2""")

# --- clustering: the same number of Lloyd steps, unrolled -----------------------------------------


def _lloyd(k: int, steps: int = STEPS, tag: str = "") -> tuple[str, str, str]:
    """CTEs for k clusters; returns (ctes, name of the last centres, name of the last assignment)."""
    x = ["log_amount", "time_sin", "time_cos", "k25"]
    u = sql_u01("row_id", "init", 0)
    ctes = [f"""c{tag}_0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY u, row_id) - 1 AS INTEGER) AS j, {', '.join(f'CAST({v} AS DOUBLE) AS c_{v}' for v in x)}
      FROM (SELECT *, {u} AS u FROM feat ORDER BY u, row_id LIMIT {k}))"""]
    dist = " + ".join(f"({v} - c_{v}) * ({v} - c_{v})" for v in x)
    for t in range(steps + 1):
        ctes.append(f"a{tag}_{t} AS MATERIALIZED (SELECT row_id, arg_min(j, ({dist}, j)) AS j, min({dist}) AS d2 FROM feat, c{tag}_{t} GROUP BY row_id)")
        if t < steps:
            means = ", ".join(f"coalesce(m_{v}, c_{v}) AS c_{v}" for v in x)
            avgs = ", ".join(f"avg({v}) AS m_{v}" for v in x)
            ctes.append(f"""c{tag}_{t + 1} AS MATERIALIZED (SELECT c.j, {means} FROM c{tag}_{t} c LEFT JOIN
              (SELECT j, {avgs} FROM a{tag}_{t} JOIN feat USING (row_id) GROUP BY j) USING (j))""")
    return ", ".join(ctes), f"c{tag}_{steps}", f"a{tag}_{steps}"


_c, _cen, _asg = _lloyd(4)
add("kmeans_steps", f"WITH {SQL_FEAT}, {_c} SELECT j AS cluster, count(row_id) AS size, " + ", ".join(f"{r(f'any_value(c_{v})')} AS {v}" for v in FEATURES)
    + f" FROM {_cen} LEFT JOIN {_asg} USING (j) GROUP BY j")
_rc, _rcen, _rasg = _lloyd(3, steps=2, tag="r")
add("registry_store", f"WITH {SQL_FEAT}, {_rc} SELECT j AS cluster, count(row_id) AS size, " + ", ".join(f"{r(f'any_value(c_{v})')} AS {v}" for v in FEATURES)
    + f", 'second' AS notes FROM {_rcen} LEFT JOIN {_rasg} USING (j) GROUP BY j")
_sweep = [(_k, *_lloyd(_k, tag=f"k{_k}")) for _k in KS]
_INERTIA = f"{SQL_FEAT}, " + ", ".join(s[1] for s in _sweep) + ", w AS (" + union([f"SELECT {s[0]} AS k, sum(d2) AS inertia FROM {s[3]}" for s in _sweep]) + ")"
add("inertia_by_k", f"WITH {_INERTIA} SELECT k, {r('inertia', 3)} AS inertia, {r('ln(inertia)', 5)} AS log_inertia FROM w")
add("elbow", f"""WITH {_INERTIA}, e AS (SELECT arg_min(inertia, k) AS y0, arg_max(inertia, k) AS y1, min(k) AS x0, max(k) AS x1 FROM w)
SELECT 'elbow' AS method, arg_max(k, abs((x1 - x0) * (inertia - y0) - (y1 - y0) * (k - x0))) AS k FROM w, e""")


def _silhouette(src: str, by: str = "") -> str:
    """Per-row silhouettes of ``src(row_id, f, cluster)``."""
    return f"""pr AS (SELECT a.row_id, a.cluster, b.cluster AS o, sum(list_distance(a.f, b.f)) AS t, count(*) AS n FROM {src} a JOIN {src} b ON a.row_id <> b.row_id GROUP BY ALL),
  ab AS (SELECT row_id, cluster, max(CASE WHEN o = cluster THEN t / n END) AS a, min(CASE WHEN o <> cluster THEN t / n END) AS b FROM pr GROUP BY 1, 2),
  sil AS (SELECT row_id, cluster, CASE WHEN a IS NULL THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)"""


_parts, _ctes = [], []
for _k in (2, 3, 4):
    _body, _, _last = _lloyd(_k, tag=f"s{_k}")
    _ctes.append(_body)
    _parts.append(f"""(WITH lab AS (SELECT row_id, f, j AS cluster FROM (SELECT *, row_number() OVER (ORDER BY {sql_u01("row_id", "silhouette", 2)}, row_id) AS rn FROM fv)
      JOIN {_last} USING (row_id) WHERE rn <= 400), {_silhouette("lab")} SELECT {_k} AS k, avg(s) AS score FROM sil)""")
add("silhouette_by_k", f"WITH {SQL_FEAT}, {', '.join(_ctes)}, sc AS ({union(_parts)}) SELECT k, {r('score', 5)} AS score, k = (SELECT arg_max(k, score) FROM sc) AS recommended FROM sc")

# --- least changes into one class of a small tree ------------------------------------------------------

add("counterfactual_rules", f"""WITH {SQL_FEAT}, b AS (SELECT row_id, k25 > {RULES[1]} AS fits, greatest(log_amount - {RULES[0]}, 0) AS d1,
  sqrt(pow(greatest({RULES[0]} - log_amount, 0), 2) + pow(greatest(time_sin - {RULES[2]}, 0), 2)) AS d2 FROM feat),
  o AS (SELECT row_id, 1 AS leaf, d1 AS d FROM b WHERE fits UNION ALL SELECT row_id, 2, d2 FROM b)
SELECT row_id, true AS found, CAST(row_number() OVER (PARTITION BY row_id ORDER BY d, leaf) AS INTEGER) AS rank, {r("d")} AS distance FROM o""")

# --- linkage by one merge after the other --------------------------------------------------------

_between = {"single": "min(d)", "complete": "max(d)", "average": "avg(d)"}


def _merging(name: str) -> str:
    if name == "ward":
        pairs = """SELECT a.c AS ca, b.c AS cb, sqrt(2.0 * a.n * b.n / (a.n + b.n) * ((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z))) AS v
          FROM (SELECT c, count(*) AS n, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM ward JOIN sup USING (i) GROUP BY c) a
          JOIN (SELECT c, count(*) AS n, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM ward JOIN sup USING (i) GROUP BY c) b ON a.c < b.c"""
    else:
        pairs = f"""SELECT a.c AS ca, b.c AS cb, {_between[name]} AS v FROM {name} a JOIN {name} b ON a.c < b.c
          JOIN sd ON sd.i = a.i AND sd.j = b.i GROUP BY 1, 2"""
    return f"""{name} AS (SELECT 0 AS step, i, i AS c, 0.0::DOUBLE AS h FROM sup UNION ALL
      SELECT step + 1, s.i, CASE WHEN s.c = m.cb THEN m.ca ELSE s.c END, m.v FROM {name} s, (SELECT * FROM ({pairs}) ORDER BY v, ca, cb LIMIT 1) m)"""


_NAMES = ["single", "complete", "average", "ward"]
_TREES = f"""WITH RECURSIVE {SQL_SUPPLIERS},
  sd AS MATERIALIZED (SELECT a.i, b.i AS j, sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z)) AS d FROM sup a JOIN sup b ON a.i <> b.i),
  {", ".join(_merging(n) for n in _NAMES)},
  trees AS MATERIALIZED ({union([f"SELECT '{n}' AS linkage, * FROM {n}" for n in _NAMES])}),
  merges AS MATERIALIZED (SELECT DISTINCT linkage, step, h FROM trees WHERE step > 0)"""
add("linkage_labels", f"""{_TREES} SELECT linkage, i AS row_id, CAST(dense_rank() OVER (PARTITION BY linkage ORDER BY c) - 1 AS INTEGER) AS cluster
  FROM trees WHERE step = (SELECT count(*) FROM sup) - 4""")
add("linkage_heights", f"{_TREES} SELECT linkage, CAST(step AS INTEGER) AS step, {r('h')} AS height FROM merges")
add("linkage_cut_heights", f"""{_TREES}, tops AS (SELECT linkage, max(h) AS top FROM merges GROUP BY 1)
  SELECT linkage, CAST(k AS INTEGER) AS cut, (SELECT count(*) FROM sup) - count(*) FILTER (h <= top * [0.2, 0.5, 0.9][k + 1]) AS n_groups
  FROM merges JOIN tops USING (linkage), range(3) AS x(k) GROUP BY linkage, k""")
add("linkage_fidelity", f"""{_TREES}, joined AS (SELECT a.linkage, a.i, b.i AS j, min(a.h) AS h FROM trees a JOIN trees b
  ON a.linkage = b.linkage AND a.step = b.step AND a.c = b.c AND a.i < b.i GROUP BY 1, 2, 3)
  SELECT linkage, {r('corr(d, h)')} AS cophenetic_corr FROM joined JOIN sd USING (i, j) GROUP BY linkage""")
add("linkage_distances", f"""WITH {SQL_EMB} SELECT a.cluster AS a, b.cluster AS b, {r('min(list_distance(a.f, b.f))')} AS single,
  {r('max(list_distance(a.f, b.f))')} AS complete, {r('avg(list_distance(a.f, b.f))')} AS average FROM emb a JOIN emb b ON a.cluster < b.cluster GROUP BY 1, 2""")

# --- scores ----------------------------------------------------------------------------------------

add("contingency_table", "SELECT l_linestatus AS t, l_returnflag AS p, count(*) AS n FROM lineitem GROUP BY 1, 2")


def _external(cells: str, by: str = "") -> str:
    """Pair counts, entropies and purity from ``cells(by, t, p, n)``."""
    b = f"{by}," if by else ""
    gb = f"GROUP BY {by}" if by else ""
    j = f"USING ({by})" if by else "ON true"
    return f"""ta AS (SELECT {b} t, sum(n)::DOUBLE AS a FROM {cells} GROUP BY {b} t), pb AS (SELECT {b} p, sum(n)::DOUBLE AS b, max(n) AS top FROM {cells} GROUP BY {b} p),
  tot AS (SELECT {b} sum(n)::DOUBLE AS nn FROM {cells} {gb}),
  s1 AS (SELECT {b} sum(n * (n - 1.0) / 2) AS cc FROM {cells} {gb}),
  s2 AS (SELECT {b} sum(a * (a - 1) / 2) AS ca, -sum(a / nn * ln(a / nn)) AS ha FROM ta JOIN tot {j} {gb}),
  s3 AS (SELECT {b} sum(b * (b - 1) / 2) AS cb, -sum(b / nn * ln(b / nn)) AS hb, sum(top) / max(nn) AS purity FROM pb JOIN tot {j} {gb}),
  s4 AS (SELECT {b} sum(n / nn * ln(nn * n / (a * b))) AS mi FROM {cells} JOIN ta USING ({b} t) JOIN pb USING ({b} p) JOIN tot {j} {gb}),
  base AS (SELECT * FROM tot JOIN s1 {j} JOIN s2 {j} JOIN s3 {j} JOIN s4 {j}),
  ext AS (SELECT {b} (cc - ca * cb / (nn * (nn - 1) / 2)) / ((ca + cb) / 2 - ca * cb / (nn * (nn - 1) / 2)) AS ari,
    greatest(mi, 0) / ((ha + hb) / 2) AS nmi, purity, mi, (ha + hb) / 2 AS mean_h FROM base)"""


_CELLS = "cells AS (SELECT l_linestatus AS t, l_returnflag AS p, count(*) AS n FROM lineitem GROUP BY 1, 2)"
add("external_scores", f"""WITH {_CELLS}, {_external("cells")},
  e AS (SELECT a, b, nn, unnest(range(greatest(1, CAST(a + b - nn AS BIGINT)), CAST(least(a, b) AS BIGINT) + 1)) AS x FROM ta, pb, tot),
  emi AS (SELECT sum(x / nn * ln(nn * x / (a * b)) * exp(lgamma(a + 1) + lgamma(b + 1) + lgamma(nn - a + 1) + lgamma(nn - b + 1)
    - lgamma(nn + 1) - lgamma(x + 1) - lgamma(a - x + 1) - lgamma(b - x + 1) - lgamma(nn - a - b + x + 1))) AS emi FROM e)
SELECT {r("ari", 8)} AS ari, {r("nmi", 8)} AS nmi, {r("nmi", 8)} AS v_measure, {r("purity", 8)} AS purity, {r("(mi - emi) / (mean_h - emi)", 8)} AS ami FROM ext, emi""")
add("external_by_group", f"""WITH {SQL_TXN}, cells AS (SELECT grp, CAST(floor(time_s / 3600) AS BIGINT) % 4 AS t, k // 25 AS p, count(*) AS n FROM txn GROUP BY ALL),
  {_external("cells", "grp")} SELECT grp, {r("ari")} AS ari, {r("nmi")} AS nmi, {r("nmi")} AS v_measure, {r("purity")} AS purity FROM ext""")
_RUNS = f"""{SQL_TXN}, lab AS (SELECT row_id, 'class' AS run, CAST(class AS BIGINT) AS cluster FROM txn UNION ALL
  SELECT row_id, 'hours', CAST(floor(time_s / 3600) AS BIGINT) FROM txn UNION ALL SELECT row_id, 'tens', CAST(k // 10 AS BIGINT) FROM txn)"""
add("agreement", f"""WITH {_RUNS}, cells AS (SELECT a.run || '|' || b.run AS g, a.cluster AS t, b.cluster AS p, count(*) AS n FROM lab a JOIN lab b USING (row_id)
  GROUP BY ALL), {_external("cells", "g")} SELECT split_part(g, '|', 1) AS run_a, split_part(g, '|', 2) AS run_b, {r("ari", 8)} AS ari FROM ext""")
_SIL = f"{SQL_EMB}, {_silhouette('emb')}"
add("silhouette_mean", f"WITH {_SIL} SELECT {r('avg(s)')} AS silhouette FROM sil")
add("silhouette_rows", f"WITH {_SIL} SELECT row_id, cluster, {r('s')} AS silhouette FROM sil")
add("silhouette_squared", f"""WITH {SQL_EMB}, pr AS (SELECT a.row_id, a.cluster, b.cluster AS o, sum(list_distance(a.f, b.f) * list_distance(a.f, b.f)) AS t, count(*) AS n
    FROM emb a JOIN emb b ON a.row_id <> b.row_id GROUP BY ALL),
  ab AS (SELECT row_id, max(CASE WHEN o = cluster THEN t / n END) AS a, min(CASE WHEN o <> cluster THEN t / n END) AS b FROM pr GROUP BY 1)
SELECT {r("avg(CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END)")} AS silhouette_squared FROM ab""")
_SPREAD = f"{SQL_EMB}, sp AS (SELECT cluster, c, avg(list_distance(f, c)) AS s, sum(list_distance(f, c) * list_distance(f, c)) AS w, count(*) AS m FROM emb JOIN cen USING (cluster) GROUP BY 1, 2)"
add("davies_bouldin", f"""WITH {_SPREAD} SELECT {r("avg(q)", 5)} AS davies_bouldin FROM (SELECT a.cluster, max((a.s + b.s) / list_distance(a.c, b.c)) AS q
  FROM sp a JOIN sp b ON a.cluster <> b.cluster GROUP BY 1)""")
add("calinski_harabasz", f"""WITH {_SPREAD}, g AS (SELECT list(m ORDER BY i) AS gc FROM (SELECT i, avg(x) AS m FROM dims GROUP BY i))
SELECT {r("(sum(m * list_distance(c, gc) * list_distance(c, gc)) / (count(*) - 1)) / (sum(w) / (sum(m) - count(*)))", 5)} AS calinski_harabasz FROM sp, g""")
add("dunn", f"""WITH {SQL_EMB} SELECT {r('''(SELECT min(list_distance(a.c, b.c)) FROM cen a JOIN cen b ON a.cluster < b.cluster)
  / (SELECT max(list_distance(a.f, b.f)) FROM emb a JOIN emb b ON a.cluster = b.cluster AND a.row_id < b.row_id)''')} AS dunn""")
add("error_analysis", f"""WITH {_SIL}, wr AS (SELECT * FROM sil ORDER BY s, row_id LIMIT 50)
SELECT count(*) AS n_inspected, {r("max(s)")} AS threshold, {r("(SELECT avg(s) FROM sil)")} AS mean_silhouette,
  {r("(SELECT avg(CASE WHEN s < 0 THEN 1.0 ELSE 0.0 END) FROM sil)")} AS frac_negative_silhouette,
  (SELECT string_agg(cluster || ':' || n, ',' ORDER BY cluster) FROM (SELECT cluster, count(*) AS n FROM wr GROUP BY cluster)) AS per_cluster_counts,
  {r("avg(CASE WHEN cluster >= 5 THEN 1.0 ELSE 0.0 END)")} AS label_rate_worst,
  {r("(SELECT avg(CASE WHEN cluster >= 5 THEN 1.0 ELSE 0.0 END) FROM emb)")} AS label_rate_overall FROM wr""")
add("ranked_scores", f"""WITH {SQL_TXN}, s AS (SELECT grp, CASE WHEN max(class) = 0 THEN avg(amount) END AS score FROM txn GROUP BY grp)
SELECT grp, {r("score")} AS score, CAST(row_number() OVER (ORDER BY score DESC NULLS LAST) - 1 AS INTEGER) AS place FROM s""")
_labs = ", ".join(f"CASE WHEN {sql_u01('row_id', 'drawn', q)} >= 0.3 THEN CAST(floor({sql_u01('row_id', 'lab', q)} * 3) AS INTEGER) END AS l{q}" for q in range(5))
_co = " + ".join(f"coalesce(CAST(a.l{q} = b.l{q} AS INTEGER), 0)" for q in range(5))
_dr = " + ".join(f"CAST(a.l{q} IS NOT NULL AND b.l{q} IS NOT NULL AS INTEGER)" for q in range(5))
add("coassociation", f"""WITH {SQL_EMB}, l AS (SELECT row_id, {_labs} FROM emb)
SELECT CAST({_co} AS BIGINT) AS co, CAST({_dr} AS BIGINT) AS drawn, count(*) AS pairs FROM l a JOIN l b ON a.row_id < b.row_id GROUP BY 1, 2""")

# --- soft assignments --------------------------------------------------------------------------------

_SOFT = f"""{SQL_EMB}, kq AS (SELECT row_id, cen.cluster AS cluster, 1.0 / (1.0 + list_distance(f, c) * list_distance(f, c)) AS k FROM emb, cen),
  q AS (SELECT row_id, cluster, k / sum(k) OVER (PARTITION BY row_id) AS q FROM kq),
  pr AS (SELECT *, q * q / sum(q) OVER (PARTITION BY cluster) AS r FROM q), p AS (SELECT row_id, cluster, q, r / sum(r) OVER (PARTITION BY row_id) AS p FROM pr)"""
add("soft_assign", f"WITH {_SOFT} SELECT row_id, cluster, {r('q', 8)} AS q, {r('p', 8)} AS p FROM p")
add("soft_labels", f"WITH {_SOFT} SELECT row_id, arg_max(cluster, q) AS cluster FROM p GROUP BY row_id")
add("kl_loss", f"WITH {_SOFT} SELECT {r('sum(p * ln(p / q)) / count(DISTINCT row_id)', 8)} AS kl FROM p")
_BATCH = f"""{SQL_EMB}, bt AS (SELECT *, CAST(floor({sql_u01("row_id", "batch", 0)} * ceil((SELECT count(*) FROM emb) / 128.0)) AS BIGINT) AS batch FROM emb),
  sm AS (SELECT a.batch, a.row_id AS i, b.row_id AS j, list_distance(a.f, b.f) AS d, (1 - list_cosine_distance(a.f, b.f)) / 0.5 AS s
    FROM bt a JOIN bt b ON a.batch = b.batch AND a.row_id <> b.row_id),
  nn AS (SELECT batch, i, arg_min(j, d) AS pos FROM sm GROUP BY 1, 2)"""
add("batch_neighbours", f"WITH {_BATCH} SELECT batch, i AS row_id, pos AS neighbour FROM nn")
add("contrastive_loss", f"""WITH {_BATCH}, t AS (SELECT sm.batch, sm.i, s, j = pos AS is_pos, row_number() OVER (PARTITION BY sm.i, j = pos ORDER BY s DESC) AS rn
    FROM sm JOIN nn ON sm.i = nn.i),
  l AS (SELECT batch, i, ln(sum(exp(s))) - max(s) FILTER (is_pos) AS loss FROM t WHERE is_pos OR rn <= 16 GROUP BY 1, 2)
SELECT batch, count(*) AS rows, {r("avg(loss)")} AS loss FROM l GROUP BY batch""")

# --- interpretation ----------------------------------------------------------------------------------


def _profiles(feats: list[str], cluster: str, y: str) -> str:
    mom = ", ".join(f"avg({f}) AS gm_{f}, stddev_pop({f}) AS gs_{f}" for f in feats)
    per = ", ".join(f"avg({f}) AS c_{f}" for f in feats)
    z = union([f"SELECT cluster, {i} AS i, '{f}' AS feature, (c_{f} - gm_{f}) / CASE WHEN gs_{f} = 0 THEN 1 ELSE gs_{f} END AS z FROM per, g" for i, f in enumerate(feats)])
    return f"""g AS (SELECT count(*) AS nn, {mom} FROM feat), per AS (SELECT {cluster} AS cluster, count(*) AS size, avg({y}) AS label_rate, sum({y})::BIGINT AS label_count, {per} FROM feat GROUP BY 1),
  z AS ({z}), top AS (SELECT cluster, string_agg(printf('%s (%+.2fσ)', feature, z), ', ' ORDER BY abs(z) DESC, i) AS top_deviations FROM
    (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY abs(z) DESC, i) AS rn FROM z) WHERE rn <= 3 GROUP BY cluster),
  prof AS (SELECT per.cluster, size, size / nn AS share, label_rate, label_count, top_deviations FROM per JOIN top USING (cluster), g)"""


add("cluster_profiles", f"WITH {SQL_FEAT}, {_profiles(FEATURES, 'grp', 'rare')} SELECT cluster, size, {r('share')} AS share, {r('label_rate')} AS label_rate, label_count, top_deviations FROM prof")
add("domain_labels", f"""WITH {SQL_FEAT}, {_profiles(FEATURES[:3], 'k', 'class')}, e AS (SELECT *, label_rate / (SELECT avg(class) FROM feat) AS h FROM prof)
SELECT cluster, CASE WHEN label_count = 0 THEN 'Clean bulk' WHEN h >= 10 THEN 'Fraud hotspot' WHEN h >= 2 THEN 'Elevated-risk pocket'
    WHEN share >= 0.4 THEN 'Mainstream traffic' ELSE 'Ordinary niche' END AS proposed_label, size, {r("label_rate")} AS label_rate, {r("h")} AS enrichment_vs_base,
  CASE WHEN label_count = 0 THEN 'no fraud at all; the benign core of the portfolio' WHEN h >= 10 THEN printf('fraud rate %.0fx the population rate (%.2f%%)', h, label_rate * 100)
    WHEN h >= 2 THEN printf('fraud rate %.1fx the population rate', h) WHEN share >= 0.4 THEN printf('%.0f%% of all transactions, near base rate', share * 100)
    ELSE 'distinct geometry but unremarkable fraud rate' END || '; driven by ' || top_deviations AS justification FROM e""")
add("feature_means", f"WITH {SQL_FEAT} SELECT k - 1 AS cluster, count(*) AS size, {r('avg(class)')} AS label_rate, " + ", ".join(f"{r(f'avg({f})')} AS {f}" for f in FEATURES)
    + " FROM feat WHERE k - 1 <> -1 GROUP BY 1")
add("feature_summary", f"WITH {SQL_LINES} " + union([
    f"SELECT '{c}' AS feature, {r(f'avg({c})', 4)} AS mean, {r(f'stddev_pop({c})', 4)} AS std, {r(f'min({c})', 4)} AS min, {r(f'max({c})', 4)} AS max, {r(f'quantile_cont({c}, 0.5)', 4)} AS median FROM li"
    for c in LINE_FEATURES]))
add("overview", f"WITH {SQL_FEAT} SELECT count(*) AS n_rows, 4 AS n_features, {r('avg(class)')} AS label_rate, count(DISTINCT k) FILTER (k - 1 <> -1) AS n_clusters FROM feat")
add("exemplars", f"""WITH {_SIL}, m AS (SELECT cluster, arg_min(row_id, (list_distance(f, c), row_id)) AS medoid_id FROM emb JOIN cen USING (cluster) GROUP BY 1)
SELECT m.cluster, medoid_id, arg_max(row_id, (s, -row_id)) AS best_id, {r("max(s)")} AS best_silhouette, arg_min(row_id, (s, row_id)) AS boundary_id,
  {r("min(s)")} AS boundary_silhouette FROM m JOIN sil USING (cluster) GROUP BY 1, 2""")

# --- downstream, audit, drift -----------------------------------------------------------------------

add("centroid_distance", f"""WITH {SQL_EMB} SELECT row_id, {r("d")} AS distance FROM (SELECT row_id, list_distance(f, c) AS d FROM emb JOIN cen USING (cluster) WHERE cluster <> 0
  UNION ALL SELECT row_id, min(list_distance(f, c)) FROM emb JOIN cen ON cen.cluster <> 0 WHERE emb.cluster = 0 GROUP BY row_id)""")
add("ranking_by_group", f"""WITH {SQL_LINES}, src AS (SELECT l_linestatus, l_quantity AS s, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM li){ranks("src", "l_linestatus")}
SELECT l_linestatus, {r("roc_auc")} AS roc_auc, {r("average_precision")} AS average_precision FROM rk""")
add("conditional_split", f"""WITH {SQL_FEAT}, s AS (SELECT k::BIGINT AS cluster, class, row_number() OVER (PARTITION BY class ORDER BY {sql_u01("row_id", "split", 11)}, row_id)
    <= round_even(0.3 * count(*) OVER (PARTITION BY class), 0) AS is_test FROM feat)
SELECT cluster, count(*) FILTER (NOT is_test) AS n_train, count(*) FILTER (is_test) AS n_test, (coalesce(sum(class) FILTER (NOT is_test), 0))::BIGINT AS positives_train,
  (coalesce(sum(class) FILTER (is_test), 0))::BIGINT AS positives_test,
  count(*) FILTER (NOT is_test) > 10 AND coalesce(sum(class) FILTER (NOT is_test), 0) > 0 AND coalesce(sum(class) FILTER (NOT is_test), 0) < count(*) FILTER (NOT is_test) AS modelled
FROM s GROUP BY cluster HAVING count(*) FILTER (is_test) > 0""")


def _bins(src: str, col: str, n: int = 4) -> str:
    """Distinct quantile edges of one column as a list, and the bin of a value among them."""
    qs = ", ".join(f"{i / n!r}" for i in range(n + 1))
    return f"(SELECT list_sort(list_distinct(quantile_cont({col}, [{qs}]))) FROM {src})"


def _bin(value: str, edges: str) -> str:
    return f"CAST(least(greatest(len(list_filter({edges}, lambda e: e <= {value})) - 1, 0), greatest(len({edges}) - 2, 0)) AS INTEGER)"


add("quantile_strata", f"""WITH {SQL_FEAT}, e AS (SELECT {_bins("feat", "log_amount")} AS e) SELECT {_bin("log_amount", "e")} AS stratum, count(*) AS n, min(row_id) AS first_row FROM feat, e GROUP BY 1""")


def _composition(cluster: str) -> str:
    return f"""{SQL_LINES}, e AS (SELECT {_bins("li", "l_extendedprice")} AS e), s AS (SELECT {cluster} AS cluster, {_bin("l_extendedprice", "e")} AS stratum FROM li, e),
  cs AS (SELECT cluster, count(*) AS size FROM s GROUP BY 1), ps AS (SELECT stratum, count(*) / (SELECT count(*) FROM s) AS pop FROM s GROUP BY 1),
  cc AS (SELECT cluster, stratum, count(*) AS n FROM s GROUP BY 1, 2),
  comp AS (SELECT cs.cluster, size, ps.stratum, coalesce(n, 0) / size AS share, coalesce(n, 0) / size / pop AS ratio FROM cs CROSS JOIN ps LEFT JOIN cc USING (cluster, stratum))"""


add("composition", f"WITH {_composition('l_returnflag')} SELECT cluster, size, stratum, {r('share')} AS share, {r('ratio')} AS ratio FROM comp")
add("composition_audit", f"""WITH {_composition("CAST(floor(l_quantity / 10) AS INTEGER)")}, pk AS (SELECT cluster, max(ratio) AS peak FROM comp GROUP BY 1)
SELECT 'l_extendedprice' AS attribute, {r("max(peak)")} AS max_representation_ratio, coalesce(string_agg(cluster::VARCHAR, ',' ORDER BY cluster) FILTER (peak >= 1.05), '') AS concentrated_clusters,
  (SELECT count(DISTINCT stratum) FROM comp) AS n_strata FROM pk""")


def _drift(late_tax: str = "l_tax") -> str:
    cut = "(SELECT quantile_cont(ship_us, 0.5) FROM li)"
    long = union([f"SELECT '{c}' AS feature, {c if c != 'l_tax' else f'CASE WHEN ref = 1 THEN l_tax ELSE {late_tax} END'} AS v, ref FROM h" for c in LINE_FEATURES])
    edges = union([f"SELECT '{c}' AS feature, {_bins('(SELECT * FROM h WHERE ref = 1)', c, 10)} AS e" for c in LINE_FEATURES])
    return f"""{SQL_LINES}, h AS MATERIALIZED (SELECT *, CASE WHEN ship_us < {cut} THEN 1 ELSE 0 END AS ref FROM li), x AS MATERIALIZED ({long}), ed AS MATERIALIZED ({edges}),
  b AS (SELECT feature, {_bin("v", "e")} AS bin, sum(ref) AS r, sum(1 - ref) AS c FROM x JOIN ed USING (feature) GROUP BY 1, 2),
  grid AS (SELECT feature, unnest(range(greatest(len(e) - 1, 1))) AS bin FROM ed),
  sh AS (SELECT feature, bin, greatest(coalesce(r, 0) / sum(r) OVER (PARTITION BY feature), 1e-6) AS r, greatest(coalesce(c, 0) / sum(c) OVER (PARTITION BY feature), 1e-6) AS c
    FROM grid LEFT JOIN b USING (feature, bin)),
  psi AS (SELECT feature, CASE WHEN count(*) < 2 THEN 0.0 ELSE sum((c - r) * ln(c / r)) END AS psi FROM sh GROUP BY 1),
  vc AS (SELECT feature, v, sum(ref) AS r, sum(1 - ref) AS c FROM x GROUP BY 1, 2),
  cm AS (SELECT feature, sum(r) OVER w AS cr, sum(c) OVER w AS cc, sum(r) OVER (PARTITION BY feature) AS m, sum(c) OVER (PARTITION BY feature) AS n FROM vc WINDOW w AS (PARTITION BY feature ORDER BY v)),
  dd AS (SELECT feature, max(abs(cr / m - cc / n)) AS d, any_value(sqrt(m * n / (m + n)::DOUBLE)) AS f FROM cm GROUP BY 1),
  ks AS (SELECT feature, d, CASE WHEN f * d < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * (SELECT sum((CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * j * j * f * f * d * d)) FROM range(1, 101) t(j)))) END AS p FROM dd)"""


add("psi", f"WITH {_drift()} SELECT feature, {r('psi')} AS psi FROM psi")
add("ks", f"WITH {_drift()} SELECT feature, {r('d')} AS ks_statistic, {r('p')} AS ks_pvalue FROM ks")
_SHIFT = _drift("l_tax * 1.5 + 0.01")
add("feature_drift", f"WITH {_SHIFT} SELECT feature, {r('psi')} AS psi, {r('d')} AS ks_statistic, {r('p')} AS ks_pvalue, psi >= 0.2 AS drifted FROM psi JOIN ks USING (feature)")
add("drift_report", f"""WITH {_SHIFT} SELECT count(*) AS n_features, 0.2::DOUBLE AS psi_threshold, {r("max(psi)")} AS max_psi, {r("avg(psi)")} AS mean_psi, count(*) FILTER (psi >= 0.2) AS n_drifted,
  coalesce(string_agg(feature, ',' ORDER BY psi DESC, feature) FILTER (psi >= 0.2), '') AS drifted_features, max(psi) >= 0.2 AS refit_required FROM psi""")

# --- registry and streams ------------------------------------------------------------------------------

add("registry_id", f"""WITH {SQL_TXN} SELECT grp, substr(sha256('{{"data_version": "v1", "name": "' || grp || '", "params": {{"k": ' || max(k) || ', "n": ' || count(*) || '}}}}'), 1, 12) AS entry_id
FROM txn GROUP BY grp""")
add("registry_latest", "SELECT user_id || '-' || event_type AS entry_id, event_type AS name, max(event_id) AS event_id FROM events GROUP BY user_id, event_type")
add("stream_scoring", f"""WITH {SQL_FEAT}, cen AS (SELECT grp, avg(log_amount) AS a, avg(k25) AS b FROM feat GROUP BY 1),
  p AS (SELECT row_id, cen.grp AS g, sqrt((log_amount - a) * (log_amount - a) + (k25 - b) * (k25 - b)) AS d FROM feat, cen)
SELECT row_id, arg_min(g, (d, g)) AS assigned_cluster, {r("min(d)")} AS distance_to_centroid, min(d) > 2.0 AS anomalous FROM p GROUP BY row_id""")
_mon = union([f"SELECT day, '{c}' AS feature, {_bin(c, 'e')} AS bin FROM d, (SELECT {_bins('txn', c)} AS e)" for c in ("amount", "k")])
add("stream_monitor", f"""WITH {SQL_TXN}, d AS (SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS day, txn.* FROM events JOIN txn ON row_id = event_id),
  x AS ({_mon}), ref AS (SELECT feature, bin, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS r FROM x GROUP BY 1, 2),
  n AS (SELECT day, count(*) AS rows FROM d GROUP BY 1), closed AS (SELECT day, rows FROM n WHERE day + 86400 <= (SELECT max(epoch_us(ts)) FROM events) / 1e6 - 3600),
  c AS (SELECT day, feature, bin, count(*) AS c FROM x GROUP BY ALL),
  s AS (SELECT day, rows, feature, greatest(r, 1e-6) AS r, greatest(coalesce(c, 0) / rows, 1e-6) AS c FROM closed CROSS JOIN ref LEFT JOIN c USING (day, feature, bin))
SELECT day AS window_start, rows, feature, {r("sum((c - r) * ln(c / r))")} AS psi, sum((c - r) * ln(c / r)) >= 0.2 AS drifted FROM s GROUP BY 1, 2, 3""")
