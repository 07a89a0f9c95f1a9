"""The same results as ``plans.catalog`` in SQL over the raw tables."""

from __future__ import annotations

from tasteline.functions.labels import ALS_FIELDS
from tasteline.operators.als import BLOCKS
from tasteline.plans.catalog import (
    ALS_GRID,
    BIAS_GRID,
    DAMPING,
    FRACTION,
    MAP_ROWS,
    MAP_TYPES,
    SMALL_FRACTION,
    TABLES,
    TOP,
)
from tasteline.operators.sampling import DEFAULT_SEED, MIN_EVAL_FRACTION
from tasteline.operators.tags import NEIGHBOURS


def _padded(prefix: str, key: str) -> str:
    digits = f"CAST({key} AS VARCHAR)"
    return f"'{prefix}' || lpad({digits}, CAST(greatest(8, length({digits})) AS INTEGER), '0')"


_INTER = f"""
pairs AS (
  SELECT o_custkey, l_partkey, CAST(sum(l_quantity) AS INTEGER) AS "count"
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey, l_partkey),
inter AS (
  SELECT {_padded('U', 'o_custkey')} AS user_id, "count",
         {_padded('T', 'l_partkey')} AS track_id,
         CASE (o_custkey * 31 + l_partkey) % 10 WHEN 8 THEN 'validation' WHEN 9 THEN 'test' ELSE 'train' END AS split
  FROM pairs)"""

_CODES = f"""{_INTER},
ucode AS (
  SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_index
  FROM (SELECT DISTINCT user_id FROM inter WHERE split = 'train')),
tcode AS (
  SELECT track_id, CAST(row_number() OVER (ORDER BY track_id) - 1 AS INTEGER) AS track_index
  FROM (SELECT DISTINCT track_id FROM inter))"""

_ENC = f"""{_CODES},
enc AS (SELECT * FROM inter JOIN ucode USING (user_id) JOIN tcode USING (track_id)),
train AS (SELECT * FROM enc WHERE split = 'train'),
val AS (SELECT * FROM enc WHERE split = 'validation'),
test AS (SELECT * FROM enc WHERE split = 'test'),
users AS (SELECT DISTINCT user_index FROM val)"""


def _bucket(key: str, seed: int = DEFAULT_SEED) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {key}, '{seed}')), 1, 8) AS BIGINT)"


def _drawn(key: str, fraction: float, seed: int = DEFAULT_SEED) -> str:
    return f"{_bucket(key, seed)} < {round(fraction * 2**32)}"


_DRAWN = f"""{_INTER},
drawn AS (SELECT DISTINCT user_id FROM inter WHERE split = 'validation')"""

_MU = 'mu AS (SELECT CAST(sum("count") AS DOUBLE) / count(*) AS mu FROM train)'


def _bias(users: bool, damping: float) -> str:
    user_term = (
        f"""
bu AS (
  SELECT user_index, (sum("count") - count(*) * any_value(mu) - sum(item_bias)) / (count(*) + {damping}) AS user_bias
  FROM train JOIN bi USING (track_index), mu GROUP BY user_index)"""
        if users
        else "\nbu AS (SELECT CAST(-1 AS INTEGER) AS user_index, 0.0 AS user_bias WHERE false)"
    )
    return f"""{_ENC}, {_MU},
bi AS (
  SELECT track_index, (sum("count") - count(*) * any_value(mu)) / (count(*) + {damping}) AS item_bias
  FROM train, mu GROUP BY track_index),{user_term}"""


def _lists(scores: str, exclude_seen: bool) -> str:
    """CTE ``lists`` (user_index, pos, track_index, rating) of the first TOP tracks."""
    unseen = "WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_index = u.user_index AND t.track_index = s.track_index)"
    return f"""
scores AS ({scores}),
lists AS (
  SELECT * FROM (
    SELECT u.user_index, s.track_index, s.rating,
           CAST(row_number() OVER (PARTITION BY u.user_index ORDER BY s.rating DESC, s.track_index) AS INTEGER) AS pos
    FROM users u CROSS JOIN scores s {unseen if exclude_seen else ''})
  WHERE pos <= {TOP})"""


_BIAS_SCORES = "SELECT track_index, item_bias AS rating FROM bi"

_HITS = """
hits AS (
  SELECT l.user_index, l.pos, row_number() OVER (PARTITION BY l.user_index ORDER BY l.pos) AS nth
  FROM lists l JOIN val v ON v.user_index = l.user_index AND v.track_index = l.track_index),
sizes AS (
  SELECT user_index, n_truth, n_predicted
  FROM (SELECT user_index, count(*) AS n_truth FROM val GROUP BY user_index)
  JOIN (SELECT user_index, count(*) AS n_predicted FROM lists GROUP BY user_index) USING (user_index))"""


def _per_user(k: int) -> str:
    return f"""
per_user AS (
  SELECT s.user_index,
    coalesce(sum(CASE WHEN pos <= {k} THEN 1 END), 0) / {float(k)} AS precision_at_k,
    count(pos) / CAST(n_predicted AS DOUBLE) AS precision_list,
    coalesce(sum(CASE WHEN pos <= {k} THEN 1 END), 0) / CAST(n_truth AS DOUBLE) AS recall_at_k,
    coalesce(sum(nth / CAST(pos AS DOUBLE)), 0) / n_truth AS map,
    coalesce(sum(CASE WHEN pos <= {k} THEN nth / CAST(pos AS DOUBLE) END), 0) / least(n_truth, {k}) AS map_at_k,
    coalesce(sum(CASE WHEN pos <= {k} THEN 1 / ln(pos + 1) END), 0)
      / list_sum(list_transform(range(1, least(n_truth, {k}) + 1), lambda i: 1 / ln(i + 1))) AS ndcg_at_k
  FROM sizes s LEFT JOIN hits h ON h.user_index = s.user_index
  GROUP BY s.user_index, n_truth, n_predicted)"""


_POINTS = ", ".join(
    f"({i}, {str(p.items).lower()}, {str(p.users).lower()}, CAST({p.damping!r} AS DOUBLE))"
    for i, p in enumerate(BIAS_GRID)
)

# Place of each track in a run, less the seen tracks before it, decides on a hit.
_TUNED = f"""{_ENC}, {_MU},
points(run_no, items, users_flag, damping) AS (VALUES {_POINTS}),
sums AS (SELECT track_index, sum("count") AS s, count(*) AS n FROM train GROUP BY track_index),
places AS (
  SELECT run_no, track_index, row_number() OVER (
    PARTITION BY run_no
    ORDER BY CASE WHEN items THEN (s - n * mu) / (n + damping) ELSE 0.0 END DESC, track_index) AS place
  FROM sums, mu, points),
before AS (
  SELECT v.user_index, v.track_index, p.run_no, any_value(p.place) AS place,
         count(*) FILTER (WHERE q.place < p.place) AS seen_before
  FROM val v
  JOIN places p ON p.track_index = v.track_index
  JOIN train t ON t.user_index = v.user_index
  JOIN places q ON q.run_no = p.run_no AND q.track_index = t.track_index
  GROUP BY v.user_index, v.track_index, p.run_no),
lengths AS (
  SELECT user_index, least({TOP}, (SELECT count(*) FROM sums) - count(*)) AS n_list
  FROM train WHERE user_index IN (SELECT user_index FROM users) GROUP BY user_index),
user_scores AS (
  SELECT run_no, user_index,
         count(*) FILTER (WHERE place - seen_before <= {TOP}) / CAST(any_value(n_list) AS DOUBLE) AS score
  FROM before JOIN lengths USING (user_index) GROUP BY run_no, user_index),
tuned AS (
  SELECT CAST(run_no AS INTEGER) AS run_no, items, users_flag AS users, damping, round(avg(score), 6) AS "Metric"
  FROM user_scores JOIN points USING (run_no) GROUP BY run_no, items, users_flag, damping)"""

_RUNS = """
runs AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'spark 0.25' WHEN 'N' THEN 'spark 1.0' ELSE 'lenskit 0.01' END AS series,
    CAST(CAST(l_quantity * 10 AS INTEGER) AS DOUBLE) AS "Rank",
    CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE ELSE 10.0 END AS "Reg",
    CASE WHEN l_tax < 0.05 THEN 1.0::DOUBLE ELSE 80.0 END AS "Alpha",
    CASE WHEN l_linenumber <= 4 THEN 5.0::DOUBLE ELSE 10.0 END AS "Maxiter",
    l_discount AS "Metric", l_extendedprice AS "Time_TTL", l_tax AS "Time_fit",
    l_quantity AS "Time_rec", CAST(l_suppkey AS DOUBLE) AS "Time_evl"
  FROM lineitem),
sliced AS (SELECT * FROM runs WHERE "Reg" = 1 AND "Alpha" = 1 AND "Maxiter" = 5)"""

_VECTORS = """
vec AS (
  SELECT vec_id, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE) * 64)) AS e, count(*) OVER () AS n
  FROM embeddings)"""

_TAGGED = f"""{_CODES}, {_VECTORS},
artist_tags AS (SELECT DISTINCT p_brand AS artist_id, p_type AS mbtag FROM part),
one_tag AS (
  SELECT artist_id, mbtag FROM (
    SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY {_bucket('artist_id, mbtag')}, mbtag) AS n FROM artist_tags)
  WHERE n = 1),
coded AS (
  SELECT c.track_id, c.track_index, o.mbtag
  FROM tcode c
  JOIN (SELECT {_padded('T', 'p_partkey')} AS track_id, p_brand AS artist_id FROM part) p USING (track_id)
  JOIN one_tag o USING (artist_id)),
tagged AS (
  SELECT coded.*, track_index AS id, e AS features
  FROM coded JOIN vec ON vec_id = track_index % n)"""

_TAG_LIST = ", ".join(f"'{t}'" for t in MAP_TYPES)
_TAG_CASE = " ".join(f"WHEN '{t}' THEN '{i}_{t}'" for i, t in enumerate(MAP_TYPES))

_ALL_METRICS = """SELECT count(*) AS n_users, round(avg(precision_at_k), 6) AS precision_at_k,
       round(avg(precision_list), 6) AS precision_list, round(avg(recall_at_k), 6) AS recall_at_k,
       round(avg(map), 6) AS map, round(avg(map_at_k), 6) AS map_at_k, round(avg(ndcg_at_k), 6) AS ndcg_at_k
FROM per_user"""

_GIVEN = f"""{_ENC}, {_VECTORS},
uvec AS (SELECT user_index, e FROM users JOIN vec ON vec_id = user_index % n),
tvec AS (SELECT track_index, e FROM (SELECT DISTINCT track_index FROM train) JOIN vec ON vec_id = track_index % n)"""


def _given_lists(unseen: str) -> str:
    return f"""
given_lists AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY user_index ORDER BY rating DESC, track_index) AS INTEGER) AS pos
    FROM (SELECT user_index, track_index, list_dot_product(u.e, t.e) AS rating FROM uvec u, tvec t {unseen}))
  WHERE pos <= {TOP})"""


def _on_test(sql: str) -> str:
    """The same query with the test split in place of the validation split."""
    return sql.replace("WHERE split = 'validation')", "WHERE split = 'test')")


_ALS_POINTS = "(VALUES " + ", ".join(
    f"({i}, {float(p.rank)}::DOUBLE, {p.reg}::DOUBLE, {p.alpha}::DOUBLE, {float(p.max_iter)}::DOUBLE)"
    for i, p in enumerate(ALS_GRID)
) + ') AS points(run_no, "Rank", "Reg", "Alpha", "Maxiter")'

_ROW_KEY = 'user_id, track_id, "count"'
_ROW_COLUMNS = 'user_id, "count", track_id'


def _series(metric: str, where: str, skip: int = 0) -> str:
    return f"""WITH {_RUNS}
SELECT series, "Rank", "{metric}" FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY "Rank", "{metric}") AS n FROM sliced WHERE {where})
WHERE n > {skip}"""


def _subsample(rest: str, fraction: float) -> str:
    kept = "user_id IN (SELECT user_id FROM drawn)"
    return f"""WITH {_DRAWN}
SELECT {_ROW_COLUMNS} FROM inter WHERE split = 'train' AND {kept}
UNION ALL
SELECT {rest} {_ROW_COLUMNS} FROM inter
WHERE split = 'train' AND NOT {kept} AND {_drawn(_ROW_KEY, fraction)}"""


_DRAWN_ROWS = f"""WITH {_DRAWN}
SELECT {_ROW_COLUMNS} FROM inter WHERE split = 'train' AND user_id"""

ORACLE_SQL: dict[str, str] = {
    "interactions": f"WITH {_INTER} SELECT {_ROW_COLUMNS}, split FROM inter",
    "split_counts": f"WITH {_INTER} SELECT split, count(*) AS n_rows FROM inter GROUP BY split",
    "list_tables": " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n_rows FROM {t}" for t in TABLES),
    "user_codes": f"WITH {_CODES} SELECT user_id, user_index FROM ucode",
    "track_codes": f"WITH {_CODES} SELECT track_id, track_index FROM tcode",
    "arbitrary_codes": f"""WITH {_CODES}
SELECT count(*) AS n_codes, min(track_index) AS least, max(track_index) AS greatest,
       count(DISTINCT track_index) AS n_distinct FROM tcode""",
    "track_universe": f"WITH {_INTER} SELECT DISTINCT track_id FROM inter",
    "encoding_pairs": f"WITH {_ENC} SELECT DISTINCT track_id, track_index FROM enc",
    "encoded_val": f"WITH {_ENC} SELECT {_ROW_COLUMNS}, user_index, track_index FROM val",
    "encoded_test": f"WITH {_ENC} SELECT {_ROW_COLUMNS}, user_index, track_index FROM test",
    "encoded_left": f"""WITH {_INTER},
part_code AS (
  SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_index
  FROM (SELECT DISTINCT user_id FROM inter WHERE split = 'train' AND {_drawn('user_id', FRACTION)}))
SELECT {_ROW_COLUMNS}, user_index FROM inter LEFT JOIN part_code USING (user_id) WHERE split = 'validation'""",
    "eval_user_ids": f"WITH {_ENC} SELECT user_index FROM users",
    "truth_val": f"""WITH {_ENC}
SELECT user_index, CAST(row_number() OVER (PARTITION BY user_index ORDER BY "count", track_index) AS INTEGER) AS pos,
       track_index FROM val""",
    "truth_test": f"""WITH {_ENC},
lists AS (SELECT user_index, list(track_index ORDER BY "count", track_index) AS tracks FROM test GROUP BY user_index)
SELECT user_index, CAST(generate_subscripts(tracks, 1) AS INTEGER) AS pos, unnest(tracks) AS track_index FROM lists""",
    "restrict_users": f"{_DRAWN_ROWS} IN (SELECT user_id FROM drawn)",
    "rows_of_users": f"{_DRAWN_ROWS} IN (SELECT user_id FROM drawn)",
    "rows_not_of_users": f"{_DRAWN_ROWS} NOT IN (SELECT user_id FROM drawn)",
    "rows_except": f"""WITH {_DRAWN}
SELECT {_ROW_COLUMNS} FROM inter WHERE split = 'train'
EXCEPT SELECT {_ROW_COLUMNS} FROM inter JOIN drawn USING (user_id) WHERE split = 'train'""",
    "subsample_users": f"""{_DRAWN_ROWS} IN (
  SELECT user_id FROM drawn
  UNION SELECT user_id FROM inter WHERE split = 'train' AND {_drawn('user_id', FRACTION, 7)})""",
    "subsample_rows": _subsample("", FRACTION),
    "subsample_except": _subsample("DISTINCT", SMALL_FRACTION),
    "eval_users": f"WITH {_ENC} SELECT user_index FROM users WHERE {_drawn('user_index', MIN_EVAL_FRACTION)}",
    "roundtrip": f"""WITH {_ENC}
SELECT {_ROW_COLUMNS}, user_index, track_index FROM train
WHERE user_index IN (SELECT user_index FROM users) OR {_drawn('user_id', FRACTION)}""",
    "preview_top": f"""WITH {_ENC}
SELECT user_index, track_index, "count" FROM train ORDER BY user_index, track_index LIMIT 20""",
    "bias_items": f"WITH {_bias(False, DAMPING)} SELECT track_index, round(item_bias, 6) AS item_bias FROM bi",
    "bias_users_items": f"WITH {_bias(True, DAMPING)} SELECT user_index, round(user_bias, 6) AS user_bias FROM bu",
    "bias_global": f"WITH {_ENC}, {_MU} SELECT user_index, track_index, round(mu, 6) AS prediction FROM val, mu",
    "bias_topk": f"""WITH {_bias(False, DAMPING)}, {_lists(_BIAS_SCORES, False)}
SELECT user_index, pos, track_index, round(mu + rating, 6) AS rating FROM lists, mu""",
    "bias_topk_unseen": f"""WITH {_bias(True, DAMPING)}, {_lists(_BIAS_SCORES, True)}
SELECT user_index, pos, track_index, round(mu + user_bias + rating, 6) AS rating
FROM lists JOIN bu USING (user_index), mu""",
    "bias_precision": f"""WITH {_bias(False, DAMPING)}, {_lists(_BIAS_SCORES, True)}, {_HITS}, {_per_user(TOP)}
SELECT count(*) AS n_users, round(avg(precision_at_k), 6) AS precision_at_k,
       round(avg(precision_list), 6) AS precision_list FROM per_user""",
    "popularity_counts": f"""WITH {_ENC}
SELECT track_index, count(*) AS n_users, CAST(sum("count") AS BIGINT) AS n_plays FROM train GROUP BY track_index""",
    "popularity_topk": f"""WITH {_ENC},
{_lists('SELECT track_index, CAST(sum("count") AS DOUBLE) AS rating FROM train GROUP BY track_index', False)}
SELECT user_index, pos, track_index, rating FROM lists""",
    "ranking_metrics": f"""WITH {_ENC},
{_lists('SELECT track_index, CAST(count(*) AS DOUBLE) AS rating FROM train GROUP BY track_index', True)}, {_HITS},
{_per_user(10)}
{_ALL_METRICS}""",
    "rmse_bias": f"""WITH {_bias(True, DAMPING)}
SELECT round(sqrt(avg(pow(mu + coalesce(item_bias, 0) + coalesce(user_bias, 0) - "count", 2))), 6) AS rmse,
       count(*) AS n_rows
FROM val LEFT JOIN bi USING (track_index) LEFT JOIN bu USING (user_index), mu""",
    "bias_tune": f'WITH {_TUNED} SELECT run_no, items, users, damping, "Metric" FROM tuned',
    "factor_scores": f"""WITH {_GIVEN}
SELECT user_index, track_index, list_dot_product(u.e, t.e) AS prediction
FROM val JOIN uvec u USING (user_index) JOIN tvec t USING (track_index)""",
    "factor_topk": f"""WITH {_GIVEN}, {_given_lists('')}
SELECT user_index, pos, track_index, rating FROM given_lists""",
    "factor_topk_unseen": f"""WITH {_GIVEN}, {_given_lists('WHERE (user_index, track_index) NOT IN (SELECT user_index, track_index FROM train)')}
SELECT user_index, pos, track_index, rating FROM given_lists""",
    "factor_items": f"""WITH {_GIVEN}
SELECT track_index, pos, user_index, rating FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY track_index ORDER BY rating DESC, user_index) AS INTEGER) AS pos
  FROM (SELECT user_index, track_index, list_dot_product(u.e, t.e) AS rating FROM uvec u, tvec t))
WHERE pos <= 10""",
    "als_ids": f"WITH {_ENC} SELECT DISTINCT track_index AS id, CAST(10 AS INTEGER) AS n_features FROM train",
    "als_lists": f"""WITH {_ENC}
SELECT user_index, n_list, n_list AS n_distinct, CAST(0 AS INTEGER) AS n_seen, true AS falling FROM (
  SELECT user_index, CAST(least({TOP}, (SELECT count(DISTINCT track_index) FROM train) - count(*)) AS INTEGER) AS n_list
  FROM train WHERE user_index IN (SELECT user_index FROM users) GROUP BY user_index)""",
    "als_agree": f"""WITH {_ENC}
SELECT user_index, track_index, true AS agrees FROM val
WHERE track_index IN (SELECT track_index FROM train)""",
    "als_folded": f"WITH {_ENC} SELECT DISTINCT user_index, true AS agrees FROM train",
    "track_blocks": f"""WITH {_ENC},
degrees AS (SELECT track_index, count(*) AS n FROM train GROUP BY track_index),
coded AS (SELECT n, row_number() OVER (ORDER BY n DESC, track_index) - 1 AS code FROM degrees)
SELECT CAST(code % {BLOCKS[1]} AS INTEGER) AS block, CAST(sum(n) AS BIGINT) AS n_rows FROM coded GROUP BY code % {BLOCKS[1]}""",
    "als_saved": f"WITH {_ENC} SELECT DISTINCT track_index AS id, true AS same FROM train",
    "als_grid": f"""SELECT CAST(run_no AS INTEGER) AS run_no, "Rank", "Reg", "Alpha", "Maxiter",
  CAST({BLOCKS[0]} AS INTEGER) AS "User_blocks", CAST({BLOCKS[1]} AS INTEGER) AS "Item_blocks",
  true AS metric_ok, true AS times_ok FROM {_ALS_POINTS}""",
    "als_log": f"""SELECT 'spark 1.0' AS series, "Rank", "Reg", "Alpha", "Maxiter", true AS metric_ok FROM {_ALS_POINTS}""",
    "bias_test": _on_test(f"""WITH {_bias(False, DAMPING)}, {_lists(_BIAS_SCORES, True)}, {_HITS}, {_per_user(TOP)}
{_ALL_METRICS}"""),
    "popularity_test": _on_test(f"""WITH {_ENC},
{_lists('SELECT track_index, CAST(count(*) AS DOUBLE) AS rating FROM train GROUP BY track_index', True)}, {_HITS},
{_per_user(10)}
{_ALL_METRICS}"""),
    "artist_tag": f"WITH {_TAGGED} SELECT artist_id, mbtag FROM one_tag",
    "tag_embedding": f"""WITH {_TAGGED}
SELECT track_id, track_index, mbtag, id, CAST(len(features) AS INTEGER) AS n_features,
       array_to_string(list_transform(features, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT)), ' ') AS millionths
FROM tagged""",
    "tag_counts": f"WITH {_TAGGED} SELECT mbtag, count(track_index) AS n_tracks FROM tagged GROUP BY mbtag",
    "n_tags": f"WITH {_TAGGED} SELECT count(DISTINCT mbtag) AS n_tags FROM coded",
    "map_sample": f"""WITH {_TAGGED}
SELECT track_id, track_index, mbtag, CASE mbtag {_TAG_CASE} END AS mbtag_with_order
FROM tagged WHERE mbtag IN ({_TAG_LIST}) ORDER BY {_bucket('track_index')}, track_index LIMIT {MAP_ROWS}""",
    "map_edges": f"""WITH {_TAGGED},
sample AS (
  SELECT track_index AS i, features AS e FROM tagged WHERE mbtag IN ({_TAG_LIST})
  ORDER BY {_bucket('track_index')}, track_index LIMIT {MAP_ROWS}),
apart AS (
  SELECT a.i, b.i AS j,
         list_dot_product(a.e, a.e) + list_dot_product(b.e, b.e) - 2 * list_dot_product(a.e, b.e) AS distance2
  FROM sample a JOIN sample b ON a.i <> b.i),
placed AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY distance2, j) AS pos FROM apart)
SELECT i AS track_index, j AS other, CAST(pos AS INTEGER) AS pos, distance2 FROM placed WHERE pos <= {NEIGHBOURS}""",
    "als_runs": f"WITH {_RUNS} SELECT * FROM runs",
    "log_names": """SELECT DISTINCT CASE l_returnflag WHEN 'A' THEN 'stats_0_25' WHEN 'N' THEN 'stats_1_0'
  ELSE 'stats_lenskit_0_01' END AS log FROM lineitem""",
    "series_metric": _series("Metric", "series LIKE 'spark%'"),
    "series_time": _series("Time_TTL", "series LIKE 'spark%'", 2),
    "series_all": _series("Time_TTL", "true", 2),
    "series_capped": _series("Metric", '"Rank" <= 310'),
    "best_run": f"""WITH {_RUNS} SELECT * FROM runs ORDER BY "Metric" DESC, series,
  {', '.join(f'"{c}"' for c in ALS_FIELDS if c != 'Metric')} LIMIT 1""",
    "bias_runs": f"""WITH {_TUNED}
SELECT 'lenskit 0.01' AS series, items, users, damping, "Metric" FROM tuned""",
    "series_bias": f"""WITH {_TUNED}
SELECT 'lenskit 0.01' AS series, damping, "Metric" FROM tuned WHERE items AND NOT users""",
    "series_no_flags": f"""WITH {_TUNED}
SELECT 'lenskit 0.01' AS series, damping, "Metric" FROM tuned WHERE NOT items AND NOT users""",
}
