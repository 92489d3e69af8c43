"""Oracle SQL (DuckDB dialect) for the registered queries, written
independently of the Spark plans: as-of by range join, windows by
``range``.  Tables are the pre-registered driver views.
"""

from __future__ import annotations

# Shared fragments ----------------------------------------------------------

READINGS = r"""
readings AS (
  SELECT e.event_id,
         CAST(e.user_id AS VARCHAR) AS subject_id,
         m.device,
         'w' || CAST((epoch_us(e.ts) + 259200000000) // 604800000000 AS VARCHAR) AS activity,
         m.sensor,
         epoch_us(e.ts) AS timestamp,
         CASE WHEN isnan(e.value) THEN NULL ELSE e.value END AS x,
         TRY_CAST(regexp_replace(e.props, '[^0-9\.\-]', '', 'g') AS DOUBLE) AS y
  FROM events e
  JOIN (VALUES ('view', 0, 'accel'), ('click', 0, 'gyro'),
               ('signup', 1, 'accel'), ('purchase', 1, 'gyro')) m(event_type, device, sensor)
    ON e.event_type = m.event_type
  WHERE e.user_id IS NOT NULL AND e.ts IS NOT NULL AND e.event_type IS NOT NULL
    AND e.value IS NOT NULL AND NOT isnan(e.value) AND e.props IS NOT NULL
)"""

DEDUPED = r"""
deduped AS (
  SELECT subject_id, device, activity, sensor, timestamp, x, y FROM (
    SELECT *, row_number() OVER (PARTITION BY subject_id, device, activity, sensor, timestamp
                                 ORDER BY x IS NULL OR y IS NULL, x, y) AS rn
    FROM readings) WHERE rn = 1
)"""

BOUNDS = r"""
bounds AS (
  SELECT *, CASE WHEN b >= a THEN (b - a) // 3600000000 END AS n,
         CASE WHEN n_accel = 0 OR n_gyro = 0 THEN 'missing_sensor'
              WHEN n_accel < 2 OR n_gyro < 2 THEN 'too_few_samples'
              WHEN b - a < 1000000 THEN 'short_overlap'
              WHEN (b - a) // 3600000000 < 2 THEN 'short_grid' END AS reason
  FROM (
    SELECT subject_id, device, activity,
           count(*) FILTER (WHERE sensor = 'accel') AS n_accel,
           min(timestamp) FILTER (WHERE sensor = 'accel') AS min_accel,
           max(timestamp) FILTER (WHERE sensor = 'accel') AS max_accel,
           count(*) FILTER (WHERE sensor = 'gyro') AS n_gyro,
           min(timestamp) FILTER (WHERE sensor = 'gyro') AS min_gyro,
           max(timestamp) FILTER (WHERE sensor = 'gyro') AS max_gyro,
           greatest(min(timestamp) FILTER (WHERE sensor = 'accel'),
                    min(timestamp) FILTER (WHERE sensor = 'gyro')) AS a,
           least(max(timestamp) FILTER (WHERE sensor = 'accel'),
                 max(timestamp) FILTER (WHERE sensor = 'gyro')) AS b
    FROM deduped GROUP BY subject_id, device, activity)
),
ok AS (SELECT subject_id, device, activity, a, b, n FROM bounds WHERE reason IS NULL)"""

GRID = r"""
seg AS (
  SELECT subject_id, device, activity, sensor, timestamp AS t, x, y,
         lead(timestamp) OVER w AS t2, lead(x) OVER w AS x2, lead(y) OVER w AS y2
  FROM deduped
  WINDOW w AS (PARTITION BY subject_id, device, activity, sensor ORDER BY timestamp)
),
pts AS (SELECT ok.*, unnest(range(ok.n)) AS i FROM ok),
grid AS (
  SELECT p.subject_id, p.device, p.activity, s.sensor, p.i, p.n,
         s.x + (s.x2 - s.x) * ((p.i * ((p.b - p.a)::DOUBLE / (p.n - 1)) - (s.t - p.a)::DOUBLE) / (s.t2 - s.t)::DOUBLE) AS x,
         s.y + (s.y2 - s.y) * ((p.i * ((p.b - p.a)::DOUBLE / (p.n - 1)) - (s.t - p.a)::DOUBLE) / (s.t2 - s.t)::DOUBLE) AS y
  FROM pts p JOIN seg s
    ON s.subject_id = p.subject_id AND s.device = p.device AND s.activity = p.activity
   AND s.t2 IS NOT NULL AND s.t < p.b AND s.t2 > p.a
   AND (s.t - p.a)::HUGEINT * (p.n - 1) <= p.i::HUGEINT * (p.b - p.a)
   AND (p.i::HUGEINT * (p.b - p.a) < (s.t2 - p.a)::HUGEINT * (p.n - 1)
        OR (s.t2 >= p.b AND p.i = p.n - 1))
),
aligned AS (
  SELECT subject_id, device, activity, i, n,
         max(x) FILTER (WHERE sensor = 'accel') AS ax, max(y) FILTER (WHERE sensor = 'accel') AS ay,
         max(x) FILTER (WHERE sensor = 'gyro') AS gx, max(y) FILTER (WHERE sensor = 'gyro') AS gy
  FROM grid GROUP BY subject_id, device, activity, i, n
),
win AS (
  SELECT w.subject_id, w.device, w.activity, w.k, a.i - w.k * 12 AS j, a.ax, a.ay, a.gx, a.gy
  FROM (SELECT subject_id, device, activity, n, unnest(range((n - 24) // 12 + 1)) AS k
        FROM ok WHERE n >= 24) w
  JOIN aligned a ON a.subject_id = w.subject_id AND a.device = w.device AND a.activity = w.activity
   AND a.i BETWEEN w.k * 12 AND w.k * 12 + 23
),
zwin AS (
  SELECT subject_id, device, activity, k, j,
         (ax - avg(ax) OVER p) / (stddev_pop(ax) OVER p + 1e-5) AS ax,
         (ay - avg(ay) OVER p) / (stddev_pop(ay) OVER p + 1e-5) AS ay,
         (gx - avg(gx) OVER p) / (stddev_pop(gx) OVER p + 1e-5) AS gx,
         (gy - avg(gy) OVER p) / (stddev_pop(gy) OVER p + 1e-5) AS gy
  FROM win WINDOW p AS (PARTITION BY subject_id, device, activity, k)
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


CORE = _with(READINGS, DEDUPED, BOUNDS, GRID)

SQL = {
    "clean_numeric": r"""
SELECT event_id, props,
       TRY_CAST(regexp_replace(props, '[^0-9\.\-]', '', 'g') AS DOUBLE) AS k_value,
       TRY_CAST(regexp_replace(props, '[^0-9eE\.\+\-]', '', 'g') AS DOUBLE) AS k_value_exp
FROM events""",
    "device_code": _with(READINGS) + """
SELECT event_id, device, sensor, CASE device WHEN 0 THEN 'phone' WHEN 1 THEN 'watch' END AS device_name
FROM readings""",
    "sensor_readings": _with(READINGS) + """
SELECT event_id, subject_id, device, activity, sensor, timestamp, floor((x) * 1e6 + 0.5) / 1e6 AS x, floor((y) * 1e6 + 0.5) / 1e6 AS y
FROM readings""",
    "dedupe_series": _with(READINGS) + """
SELECT subject_id, device, activity, sensor, timestamp, floor((x) * 1e6 + 0.5) / 1e6 AS x, floor((y) * 1e6 + 0.5) / 1e6 AS y FROM (
  SELECT *, row_number() OVER (PARTITION BY subject_id, device, activity, sensor, timestamp
                               ORDER BY x IS NULL OR y IS NULL, x, y) AS rn
  FROM (SELECT subject_id, device, activity, sensor, timestamp - timestamp % 3600000000 AS timestamp, x, y
        FROM readings)) WHERE rn = 1""",
    "overlap_bounds": _with(READINGS, DEDUPED, BOUNDS) + """
SELECT subject_id, device, activity, n_accel, min_accel, max_accel, n_gyro, min_gyro, max_gyro, a, b
FROM bounds""",
    "eligible_pairs": _with(READINGS, DEDUPED, BOUNDS) + """
SELECT subject_id, device, activity, a, b, n FROM ok""",
    "rejected_series": _with(READINGS, DEDUPED, BOUNDS) + """
SELECT subject_id, device, activity, reason FROM bounds WHERE reason IS NOT NULL""",
    "time_grid": _with(READINGS, DEDUPED, BOUNDS) + """
SELECT subject_id, device, activity, n, i, CAST((i::HUGEINT * (b - a)) // (n - 1) AS BIGINT) AS t_off
FROM (SELECT ok.*, unnest(range(ok.n)) AS i FROM ok)""",
    "resample_linear": CORE + """
SELECT subject_id, device, activity, sensor, i, floor((x) * 1e6 + 0.5) / 1e6 AS x, floor((y) * 1e6 + 0.5) / 1e6 AS y FROM grid""",
    "align_channels": CORE + """
SELECT subject_id, device, activity, i, floor((ax) * 1e6 + 0.5) / 1e6 AS ax, floor((ay) * 1e6 + 0.5) / 1e6 AS ay,
       floor((gx) * 1e6 + 0.5) / 1e6 AS gx, floor((gy) * 1e6 + 0.5) / 1e6 AS gy FROM aligned""",
    "sliding_windows": CORE + """
SELECT subject_id, device, activity AS label, k, j, floor((ax) * 1e6 + 0.5) / 1e6 AS ax, floor((ay) * 1e6 + 0.5) / 1e6 AS ay,
       floor((gx) * 1e6 + 0.5) / 1e6 AS gx, floor((gy) * 1e6 + 0.5) / 1e6 AS gy FROM win""",
    "zscore_windows": CORE + """
SELECT subject_id, device, activity AS label, k, j, floor((ax) * 1e6 + 0.5) / 1e6 AS ax, floor((ay) * 1e6 + 0.5) / 1e6 AS ay,
       floor((gx) * 1e6 + 0.5) / 1e6 AS gx, floor((gy) * 1e6 + 0.5) / 1e6 AS gy FROM zwin""",
    "windows_pipeline": CORE + """
SELECT subject_id, device, activity AS label, k, j, floor((ax) * 1e6 + 0.5) / 1e6 AS ax, floor((ay) * 1e6 + 0.5) / 1e6 AS ay,
       floor((gx) * 1e6 + 0.5) / 1e6 AS gx, floor((gy) * 1e6 + 0.5) / 1e6 AS gy
FROM (SELECT *, bool_and(coalesce(isfinite(ax) AND isfinite(ay) AND isfinite(gx) AND isfinite(gy), FALSE))
                OVER (PARTITION BY subject_id, device, activity, k) AS finite FROM zwin)
WHERE finite""",
}


def all_sql() -> dict:
    return dict(SQL)


# ---------------------------------------------------------------------------
# Batch 2: splits, ordering, sets, profiles, lookups, scoring, metrics
# ---------------------------------------------------------------------------

from tessera import schemas as _S  # noqa: E402
from tessera.operators.order import hash_threshold as _thr  # noqa: E402


def R6(e: str) -> str:
    return f"floor(({e}) * 1e6 + 0.5) / 1e6"


SPLIT = r"""
subj AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS subject_id FROM events WHERE user_id IS NOT NULL),
ranked AS (SELECT subject_id, row_number() OVER (ORDER BY md5('42:' || subject_id), subject_id) - 1 AS r,
                  count(*) OVER () AS n FROM subj),
split AS (SELECT subject_id,
                 CASE WHEN r < ceil(0.8::DOUBLE * n) THEN 'train'
                      WHEN r < ceil(0.8::DOUBLE * n) + floor(0.1::DOUBLE * n) THEN 'val'
                      ELSE 'test' END AS split FROM ranked)"""

WK = r"""
wk AS (SELECT DISTINCT subject_id, device, activity AS label, k FROM win)"""

WL = "\nwl AS (" + " UNION ALL ".join(
    f"SELECT subject_id, device, activity, k, j, '{c}' AS channel, {c} AS value FROM win"
    for c in ["ax", "ay", "gx", "gy"]) + ")"

ACT_VALUES = ", ".join(f"({i}, '{c}', '{n}')" for i, (c, n) in enumerate(_S.ACTIVITY_NAMES))
AM = f"\nam AS (SELECT * FROM (VALUES {ACT_VALUES}) t(pos, code, name))"

def _score(cut: float = 0.8) -> str:
    """Scoring CTEs; centroids from the training rows below ``cut``."""
    return f"""
cutoff AS (SELECT vec_id FROM embeddings
           WHERE substr(md5('42:' || CAST(vec_id AS VARCHAR)), 1, 13) < '{_thr(cut)}'),
emb AS (SELECT vec_id, label, embedding,
               CASE WHEN substr(md5('42:' || CAST(vec_id AS VARCHAR)), 1, 13) < '{_thr(0.8)}'
                    THEN 'train' ELSE 'held_out' END AS split FROM embeddings),
ev AS (SELECT vec_id, label, split, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS d FROM emb),
cent AS (SELECT CAST(label AS VARCHAR) AS cls, d, avg(v) AS c FROM ev JOIN cutoff USING (vec_id) GROUP BY ALL),
classes AS (SELECT cls, row_number() OVER (ORDER BY cls) - 1 AS idx FROM (SELECT DISTINCT cls FROM cent)),
dist AS (SELECT e.vec_id, cl.idx, -sum((e.v - c.c) * (e.v - c.c)) AS logit
         FROM ev e JOIN cent c ON e.d = c.d JOIN classes cl ON cl.cls = c.cls
         GROUP BY e.vec_id, cl.idx),
mx AS (SELECT vec_id, max(logit) AS m FROM dist GROUP BY vec_id),
lse AS (SELECT d.vec_id, mx.m, mx.m + ln(sum(exp(d.logit - mx.m))) AS lse,
               min(d.idx) FILTER (WHERE d.logit = mx.m) AS y_pred
        FROM dist d JOIN mx USING (vec_id) GROUP BY d.vec_id, mx.m),
pred_all AS (SELECT e.vec_id, e.split, CAST(cl.idx AS INTEGER) AS y_true, CAST(l.y_pred AS INTEGER) AS y_pred,
                    exp(l.m - l.lse) AS confidence, l.lse - dt.logit AS xentropy
             FROM emb e JOIN classes cl ON cl.cls = CAST(e.label AS VARCHAR)
             JOIN lse l ON l.vec_id = e.vec_id
             JOIN dist dt ON dt.vec_id = e.vec_id AND dt.idx = cl.idx),
pred AS (SELECT * FROM pred_all WHERE split = 'held_out')"""


SCORE = _score()

# epoch e of 3 has learned from the first e thirds of the training rows
HISTORY = "\nhist AS (" + " UNION ALL ".join(f"""SELECT * FROM (
  WITH {_score(0.8 * e / 3)},
  shuf AS (SELECT vec_id, xentropy, y_true, y_pred,
                  (row_number() OVER (ORDER BY md5('42:{e}:' || CAST(vec_id AS VARCHAR)), vec_id) - 1) // 64 AS batch
           FROM pred_all WHERE split = 'train'),
  bat AS (SELECT batch, count(*) AS n, avg(xentropy) AS loss,
                 sum(CASE WHEN y_true = y_pred THEN 1 ELSE 0 END) AS correct FROM shuf GROUP BY batch)
  SELECT {e} AS epoch, sum(loss * n) / sum(n) AS tr_loss, sum(correct) / sum(n) AS tr_acc,
         (SELECT avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) FROM pred) AS val_acc FROM bat)"""
    for e in (1, 2, 3)) + ")"

CORE_W = CORE + "," + WK + "," + WL

SQL.update({
    "subject_split": _with(SPLIT) + "\nSELECT subject_id, split FROM split",
    "split_sizes": _with(SPLIT) + "\nSELECT split, count(*) AS n_subjects FROM split GROUP BY split",
    "split_leakage": CORE + "," + WK + "," + SPLIT + f""",
hashed AS (SELECT *, substr(md5('42:' || subject_id || ':' || device || ':' || label || ':' || k), 1, 13) AS h FROM wk),
assigned AS (SELECT 'subject' AS split_by, subject_id, split FROM wk JOIN split USING (subject_id) UNION ALL
         SELECT 'window', subject_id, CASE WHEN h < '{_thr(0.8)}' THEN 'train' WHEN h < '{_thr(0.9)}' THEN 'val'
                                           ELSE 'test' END FROM hashed),
per AS (SELECT split_by, subject_id, count(*) AS n, count(DISTINCT split) AS n_splits FROM assigned GROUP BY ALL)
SELECT split_by, count(*) AS n_subjects, CAST(sum(n) AS BIGINT) AS n_windows,
       count(*) FILTER (WHERE n_splits > 1) AS n_leaking FROM per GROUP BY split_by""",
    "semi_split": CORE + "," + WK + "," + SPLIT + """
SELECT subject_id, device, label, k FROM wk
WHERE subject_id IN (SELECT subject_id FROM split WHERE split = 'train')""",
    "anti_split": CORE + "," + WK + "," + SPLIT + """
SELECT subject_id, device, label, k FROM wk
WHERE subject_id NOT IN (SELECT subject_id FROM split WHERE split = 'train')""",
    "common_activities": _with(READINGS) + """
SELECT subject_id, device, activity FROM readings WHERE sensor = 'accel'
INTERSECT
SELECT subject_id, device, activity FROM readings WHERE sensor = 'gyro'""",
    "union_devices": CORE + "," + WK + "\nSELECT subject_id, device, label, k FROM wk",
    "hash_sample": f"""
SELECT event_id FROM events
WHERE substr(md5('99:' || CAST(event_id AS VARCHAR)), 1, 13) < '{_thr(0.10)}'""",
    "epoch_shuffle": """
SELECT vec_id, row_number() OVER (ORDER BY md5('42:1:' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS pos
FROM embeddings""",
    "batch_ids": """
SELECT vec_id, pos, pos // 64 AS batch FROM (
  SELECT vec_id, row_number() OVER (ORDER BY md5('42:2:' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS pos
  FROM embeddings)""",
    "limit_n": _with(READINGS) + "\nSELECT event_id, timestamp FROM readings ORDER BY timestamp, event_id LIMIT 10",
    "sorted_series": _with(READINGS) + """
SELECT event_id, row_number() OVER (ORDER BY subject_id, device, activity, sensor, timestamp, event_id) - 1 AS pos
FROM readings""",
    "publish_order": CORE + "," + WK + """
SELECT subject_id, device, label, k, row_number() OVER (ORDER BY device, subject_id, label, k) - 1 AS seq FROM wk""",
    "filter_eq": _with(READINGS) + "\nSELECT event_id, subject_id FROM readings WHERE device = 0 AND sensor = 'accel'",
    "clip_to_overlap": _with(READINGS, DEDUPED, BOUNDS) + """
SELECT r.event_id, r.subject_id, r.device, r.activity, r.sensor, r.timestamp
FROM readings r JOIN ok USING (subject_id, device, activity)
WHERE r.timestamp BETWEEN ok.a AND ok.b""",
    "window_counts": CORE + "," + WK + """
SELECT device, subject_id, label, count(*) AS n_windows FROM wk GROUP BY ROLLUP (device, subject_id, label)""",
    "distinct_labels": CORE + "," + WK + "\nSELECT DISTINCT label FROM wk",
    "row_counts": CORE + "," + WK + """
SELECT (SELECT count(*) FROM readings) AS n_readings, (SELECT count(*) FROM bounds) AS n_keys,
       (SELECT count(*) FROM bounds WHERE reason IS NULL) AS n_usable, (SELECT count(*) FROM wk) AS n_windows""",
    "array_summary": CORE_W + f"""
SELECT {R6('min(value)')} AS min, {R6('max(value)')} AS max, {R6('avg(value)')} AS mean,
       {R6('stddev_samp(value)')} AS std, count(*) AS n_values, CAST(count(*) // 96 AS BIGINT) AS n_windows,
       CAST(24 AS BIGINT) AS rows, 4 AS channels FROM wl""",
    "channel_stats": CORE_W + f"""
SELECT channel, {R6('avg(value)')} AS mean, {R6('stddev_pop(value)')} AS std, {R6('min(value)')} AS min,
       {R6('max(value)')} AS max, count(value) AS n FROM wl GROUP BY channel""",
    "finite_check": CORE_W + """
SELECT channel, bool_or(isnan(value)) AS has_nan, bool_or(isinf(value)) AS has_inf,
       bool_or(value IS NULL) AS has_null FROM wl GROUP BY channel""",
    "corr_matrix": CORE + "\n" + " UNION ALL ".join(
        f"SELECT '{a}' AS c1, '{b}' AS c2, {R6(f'corr({a}, {b})')} AS corr FROM win"
        for a in ["ax", "ay", "gx", "gy"] for b in ["ax", "ay", "gx", "gy"]),
    "box_stats": CORE_W + f""",
q AS (SELECT channel, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM wl GROUP BY channel)
SELECT q.channel, {R6('q1')} AS q1, {R6('median')} AS median, {R6('q3')} AS q3, {R6('q3 - q1')} AS iqr,
       {R6('min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1))')} AS whisker_lo,
       {R6('max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1))')} AS whisker_hi,
       count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM wl JOIN q USING (channel) GROUP BY q.channel, q1, median, q3""",
    "histogram": CORE_W + f""",
rng AS (SELECT channel, min(value) AS lo, max(value) AS hi FROM wl GROUP BY channel),
cnt AS (SELECT channel, CAST(CASE WHEN hi - lo = 0 THEN 0
                                  ELSE least(floor((value - lo) / (hi - lo) * 30), 29) END AS INTEGER) AS bin,
               count(*) AS count
        FROM wl JOIN rng USING (channel) WHERE value IS NOT NULL GROUP BY ALL),
bins AS (SELECT channel, lo, hi, CAST(unnest(range(30)) AS INTEGER) AS bin FROM rng)
SELECT b.channel, b.bin, {R6('lo + b.bin * (hi - lo) / 30')} AS edge_lo,
       {R6('lo + (b.bin + 1) * (hi - lo) / 30')} AS edge_hi, coalesce(c.count, 0) AS count
FROM bins b LEFT JOIN cnt c ON b.channel = c.channel AND b.bin = c.bin""",
    "standardize": CORE_W + f""",
st AS (SELECT channel, avg(value) AS m, stddev_pop(value) AS s FROM wl GROUP BY channel)
SELECT subject_id, device, activity AS label, k, j, channel,
       {R6('(value - m) / CASE WHEN s = 0 OR s IS NULL THEN 1.0 ELSE s END')} AS value
FROM wl JOIN st USING (channel)""",
    "melt_channels": CORE_W + f"""
SELECT subject_id, device, activity AS label, k, j AS i, channel AS axis, {R6('value')} AS value FROM wl""",
    "code_lookup": _with(AM) + r"""
SELECT l_orderkey, l_linenumber, code, coalesce(am.name, 'Unknown (' || code || ')') AS name
FROM (SELECT l_orderkey, l_linenumber, regexp_replace(l_returnflag, '^\s+|\s+$', '', 'g') AS code FROM lineitem) li
LEFT JOIN am USING (code)""",
    "trim_code": r"""
SELECT conv_id, turn, regexp_replace(role, '^\s+|\s+$', '', 'g') AS role FROM conversations""",
    "label_index": """
SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx
FROM (SELECT DISTINCT p_type AS label FROM part WHERE p_type IS NOT NULL)""",
    "resolve_labels": _with(AM) + """,
cls AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx FROM (
          SELECT DISTINCT label FROM (SELECT p_name AS label FROM part UNION ALL
                                      SELECT l_returnflag FROM lineitem UNION ALL
                                      SELECT role FROM conversations) WHERE label IS NOT NULL)),
res AS (SELECT c.idx, c.label AS class_name,
               coalesce((SELECT code FROM am WHERE am.code = c.label),
                        (SELECT code FROM am WHERE am.name = c.label),
                        (SELECT code FROM am WHERE contains(c.label, am.name) OR contains(am.name, c.label)
                         ORDER BY pos LIMIT 1),
                        'Class-' || CAST(c.idx AS VARCHAR)) AS letter
        FROM cls c)
SELECT idx, class_name, letter, coalesce((SELECT name FROM am WHERE am.code = res.letter), class_name) AS activity_name
FROM res""",
    "centroid_scores": _with(SCORE) + f"""
SELECT vec_id, y_true, y_pred, {R6('confidence')} AS confidence, {R6('xentropy')} AS xentropy FROM pred_all""",
    "softmax_scores": _with(SCORE) + f"""
SELECT d.vec_id, CAST(d.idx AS INTEGER) AS class_idx, {R6('exp(d.logit - l.lse)')} AS prob
FROM dist d JOIN lse l USING (vec_id)""",
    "confusion_matrix": _with(SCORE) + """
SELECT CAST(t.idx AS INTEGER) AS y_true, CAST(p.idx AS INTEGER) AS y_pred, count(pr.vec_id) AS count
FROM classes t JOIN classes p ON TRUE
LEFT JOIN pred pr ON pr.y_true = t.idx AND pr.y_pred = p.idx
GROUP BY t.idx, p.idx""",
    "classification_report": _with(SCORE) + f""",
cc AS (SELECT c.idx, c.cls AS class_name,
              (SELECT count(*) FROM pred WHERE y_true = c.idx AND y_pred = c.idx) AS tp,
              (SELECT count(*) FROM pred WHERE y_pred = c.idx) AS predicted,
              (SELECT count(*) FROM pred WHERE y_true = c.idx) AS support FROM classes c),
per AS (SELECT class_name, support, tp,
               CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
               CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM cc),
per2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                        ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM per)
SELECT class_name, {R6('precision')} AS precision, {R6('recall')} AS recall, {R6('f1')} AS f1, support FROM per2
UNION ALL SELECT 'accuracy', NULL, NULL, {R6('CASE WHEN sum(support) = 0 THEN 0.0 ELSE sum(tp) / sum(support) END')},
                 CAST(sum(support) AS BIGINT) FROM per2
UNION ALL SELECT 'macro avg', {R6('avg(precision)')}, {R6('avg(recall)')}, {R6('avg(f1)')},
                 CAST(sum(support) AS BIGINT) FROM per2
UNION ALL SELECT 'weighted avg', {R6('sum(precision * support) / sum(support)')},
                 {R6('sum(recall * support) / sum(support)')}, {R6('sum(f1 * support) / sum(support)')},
                 CAST(sum(support) AS BIGINT) FROM per2""",
    "per_class_accuracy": _with(SCORE) + f"""
SELECT CAST(c.idx AS INTEGER) AS idx, c.cls AS class_name,
       {R6('coalesce(avg(CASE WHEN p.y_true = p.y_pred THEN 1.0 ELSE 0.0 END), 0.0)')} AS accuracy
FROM classes c LEFT JOIN pred p ON p.y_true = c.idx GROUP BY c.idx, c.cls""",
    "p95_threshold": _with(SCORE) + f"\nSELECT {R6('quantile_cont(xentropy, 0.95)')} AS threshold_95 FROM pred_all",
    "alert_flags": _with(SCORE) + f"""
SELECT vec_id, {R6('xentropy')} AS xentropy,
       xentropy > (SELECT quantile_cont(xentropy, 0.95) FROM pred_all) AS alert FROM pred_all""",
    "epoch_metrics": _with(HISTORY) + f"""
SELECT epoch, {R6('tr_loss')} AS tr_loss, {R6('tr_acc')} AS tr_acc, {R6('val_acc')} AS val_acc FROM hist""",
    "best_epoch": _with(HISTORY) + f""",
h2 AS (SELECT *, coalesce(max(val_acc) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)
                 AS prev FROM hist)
SELECT arg_min(epoch, (-val_acc, epoch)) AS best_epoch, {R6('max(val_acc)')} AS best_val_acc,
       arg_min(epoch, (tr_loss, epoch)) AS min_loss_epoch, arg_min(epoch, (-tr_acc, epoch)) AS max_acc_epoch,
       CAST(sum(CASE WHEN val_acc > prev THEN 1 ELSE 0 END) AS BIGINT) AS n_improvements FROM h2""",
})


# ---------------------------------------------------------------------------
# Batch 3: arrays, JSON, messages, streaming
# ---------------------------------------------------------------------------

STREAM = SCORE + "," + AM + """,
scored AS (
  SELECT row_number() OVER (ORDER BY p.vec_id % 2, CAST(p.vec_id AS VARCHAR)) - 1 AS seq,
         CASE p.vec_id % 2 WHEN 0 THEN 'phone' ELSE 'watch' END AS device,
         CAST(p.vec_id AS VARCHAR) AS subject_id, ta.code AS activity, pa.code AS pred_letter,
         pa.name AS pred_name, ta.name AS truth_name, p.confidence, pa.code = ta.code AS correct
  FROM pred p JOIN am ta ON ta.pos = p.y_true JOIN am pa ON pa.pos = p.y_pred)"""

SQL.update({
    "json_roundtrip": """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       CASE WHEN json_extract(props, '$.k') IS NULL THEN NULL
            ELSE '{"k":' || CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) || '}' END AS json
FROM (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN props END AS props FROM events)""",
    "flatten_reshape": CORE + "," + WK + """
SELECT subject_id, device, label, k, 24 AS n_rows, 4 AS n_cols, TRUE AS same FROM wk""",
    "window_messages": CORE + "," + WK + """
SELECT CASE device WHEN 0 THEN 'phone' WHEN 1 THEN 'watch' END AS device, subject_id, label AS activity,
       row_number() OVER (ORDER BY device, subject_id, label, k) - 1 AS seq, 24 AS n_rows, 4 AS n_cols,
       TRUE AS valid
FROM wk""",
    "stream_events": _with(READINGS) + f"""
SELECT event_id, subject_id, device, activity, sensor, timestamp, {R6('x')} AS x, {R6('y')} AS y FROM readings""",
    "stream_scores": _with(STREAM) + f"""
SELECT seq, device, subject_id, activity, pred_letter, pred_name, truth_name, {R6('confidence')} AS confidence, correct
FROM scored""",
    "stream_accuracy": _with(STREAM) + f"""
SELECT device, count(*) AS total, CAST(sum(CASE WHEN correct THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       {R6('avg(CASE WHEN correct THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM scored GROUP BY device""",
    "latest_per_key": _with(STREAM) + f"""
SELECT device, seq, subject_id, pred_letter, {R6('confidence')} AS confidence
FROM scored WHERE seq IN (SELECT max(seq) FROM scored GROUP BY device)""",
    "dead_letter": _with(STREAM) + """
SELECT seq, seq % 7 AS damage FROM scored WHERE seq % 7 IN (1, 2, 3, 4)""",
    "running_accuracy": _with(STREAM) + f"""
SELECT device, seq, row_number() OVER w AS n_seen,
       CAST(sum(CASE WHEN correct THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_correct,
       {R6('sum(CASE WHEN correct THEN 1.0 ELSE 0.0 END) OVER w / row_number() OVER w')} AS running_accuracy
FROM scored WINDOW w AS (PARTITION BY device ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
})

SQL.update({
    "paired_series": _with(READINGS) + """
SELECT a.subject_id, a.device, a.activity, a.n AS n_accel, g.n AS n_gyro
FROM (SELECT subject_id, device, activity, count(*) AS n FROM readings WHERE sensor = 'accel' GROUP BY ALL) a
JOIN (SELECT subject_id, device, activity, count(*) AS n FROM readings WHERE sensor = 'gyro' GROUP BY ALL) g
  USING (subject_id, device, activity)""",
    "interp_error": CORE + """,
chk AS (
  SELECT p.subject_id, p.device, p.activity, s.sensor,
         s.x + (s.x2 - s.x) * ((p.i * ((p.b - p.a)::DOUBLE / (p.n - 1)) - (s.t - p.a)::DOUBLE) / (s.t2 - s.t)::DOUBLE) AS x,
         s.y + (s.y2 - s.y) * ((p.i * ((p.b - p.a)::DOUBLE / (p.n - 1)) - (s.t - p.a)::DOUBLE) / (s.t2 - s.t)::DOUBLE) AS y,
         least(greatest(p.a::DOUBLE + p.i::DOUBLE * (p.b - p.a)::DOUBLE / (p.n - 1)::DOUBLE, s.t::DOUBLE), s.t2::DOUBLE) AS ti,
         s.t, s.t2, s.x AS x1, s.x2, s.y AS y1, s.y2
  FROM pts p JOIN seg s
    ON s.subject_id = p.subject_id AND s.device = p.device AND s.activity = p.activity
   AND s.t2 IS NOT NULL AND s.t < p.b AND s.t2 > p.a
   AND (s.t - p.a)::HUGEINT * (p.n - 1) <= p.i::HUGEINT * (p.b - p.a)
   AND (p.i::HUGEINT * (p.b - p.a) < (s.t2 - p.a)::HUGEINT * (p.n - 1)
        OR (s.t2 >= p.b AND p.i = p.n - 1))
)
SELECT subject_id, device, activity, sensor, count(*) AS n_points,
       floor((max(abs(x - (x1 + (ti - t::DOUBLE) * ((x2 - x1) / (t2 - t)::DOUBLE))))) * 1e6 + 0.5) / 1e6 AS max_err_x,
       floor((max(abs(y - (y1 + (ti - t::DOUBLE) * ((y2 - y1) / (t2 - t)::DOUBLE))))) * 1e6 + 0.5) / 1e6 AS max_err_y
FROM chk GROUP BY subject_id, device, activity, sensor""",
    "finite_windows": CORE.replace("aligned AS (", """dirty AS (
  SELECT * REPLACE (CASE WHEN i % 97 = 5 THEN 'nan'::DOUBLE WHEN i % 89 = 7 THEN '-inf'::DOUBLE
                         WHEN i % 83 = 11 THEN NULL ELSE x END AS x) FROM grid),
aligned AS (""").replace("FROM grid GROUP BY subject_id, device, activity, i, n", "FROM dirty GROUP BY subject_id, device, activity, i, n") + """
SELECT subject_id, device, activity AS label, k FROM win
GROUP BY subject_id, device, activity, k
HAVING bool_and(ax IS NOT NULL AND ay IS NOT NULL AND gx IS NOT NULL AND gy IS NOT NULL
                AND NOT (isnan(ax) OR isnan(ay) OR isnan(gx) OR isnan(gy))
                AND NOT (isinf(ax) OR isinf(ay) OR isinf(gx) OR isinf(gy)))""",
})

SQL.update({
    "rejected_readings": """
SELECT event_type, reason, count(*) AS n_rows FROM (
  SELECT event_type, CASE
    WHEN event_type IS NULL OR user_id IS NULL OR ts IS NULL OR value IS NULL OR isnan(value) OR props IS NULL
      THEN 'null_field'
    WHEN event_type NOT IN ('view', 'click', 'signup', 'purchase') THEN 'no_sensor' END AS reason FROM events)
WHERE reason IS NOT NULL GROUP BY ALL""",
    "zscore_sample": CORE + f"""
SELECT subject_id, device, activity AS label, k, j, {", ".join(
    f"{R6(f'({c} - avg({c}) OVER p) / (stddev_samp({c}) OVER p + 1e-5)')} AS {c}" for c in ["ax", "ay", "gx", "gy"])}
FROM win WINDOW p AS (PARTITION BY subject_id, device, activity, k)""",
})


# readings at six-hourly times, duplicates kept, cut to the common range
CLIPPED = r"""
deduped AS (SELECT subject_id, device, activity, sensor, timestamp - timestamp % 21600000000 AS timestamp, x, y
            FROM readings)""" + "," + BOUNDS + r""",
cut AS (SELECT r.*, ok.a, ok.b, ok.n, x IS NULL OR y IS NULL AS part FROM deduped r JOIN ok USING (subject_id, device, activity)
        WHERE timestamp BETWEEN a AND b),
times AS (
  SELECT subject_id, device, activity, sensor, timestamp AS t, a, b, n,
         first(x ORDER BY part, x IS NULL, x, y IS NULL, y) AS fx, first(y ORDER BY part, x IS NULL, x, y IS NULL, y) AS fy,
         first(x ORDER BY part DESC, x IS NULL DESC, x DESC, y IS NULL DESC, y DESC) AS lx,
         first(y ORDER BY part DESC, x IS NULL DESC, x DESC, y IS NULL DESC, y DESC) AS ly
  FROM cut GROUP BY ALL),
kept AS (SELECT subject_id, device, activity FROM
         (SELECT subject_id, device, activity, sensor FROM times GROUP BY ALL HAVING count(*) > 1)
         GROUP BY ALL HAVING count(*) = 2),
seg AS (
  SELECT *, lead(t) OVER w AS t2, lead(fx) OVER w AS fx2, lead(fy) OVER w AS fy2, row_number() OVER w AS r,
         count(*) OVER (PARTITION BY subject_id, device, activity, sensor) AS m
  FROM times JOIN kept USING (subject_id, device, activity)
  WINDOW w AS (PARTITION BY subject_id, device, activity, sensor ORDER BY t)),
pts AS (SELECT s.*, i, (i * ((b - a)::DOUBLE / (n - 1)) - (t - a)::DOUBLE) / (t2 - t)::DOUBLE AS f
        FROM seg s, unnest(range(n)) u(i)
        WHERE t2 IS NOT NULL AND (r = 1 OR i::HUGEINT * (b - a) > (t - a)::HUGEINT * (n - 1))
          AND (r = m - 1 OR i::HUGEINT * (b - a) <= (t2 - a)::HUGEINT * (n - 1)))"""

# the readings of every 50th user as one activity, the last ones again 100,000 hours later
FAR = r"""
own AS (SELECT subject_id, device, 'all' AS activity, sensor, timestamp, x, y FROM readings
        WHERE CAST(subject_id AS BIGINT) % 50 = 0),
more AS (SELECT * FROM own UNION ALL
         SELECT subject_id, device, activity, sensor, timestamp + 360000000000000, x, y FROM own
         QUALIFY timestamp = max(timestamp) OVER (PARTITION BY subject_id, device, activity, sensor)),
""" + DEDUPED.lstrip().replace("FROM readings)", "FROM more)")

SQL.update({
    "stream_running_accuracy": _with(STREAM) + f"""
SELECT device, seq, subject_id, activity, pred_letter, pred_name, truth_name, {R6('confidence')} AS confidence, correct,
       row_number() OVER w AS n_seen, CAST(sum(CASE WHEN correct THEN 1 ELSE 0 END) OVER w AS BIGINT) AS n_correct,
       {R6('sum(CASE WHEN correct THEN 1.0 ELSE 0.0 END) OVER w / row_number() OVER w')} AS running_accuracy
FROM scored WINDOW w AS (PARTITION BY device ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "latest_per_subject": CORE + "," + WK + f""",
sent AS (SELECT wk.*, row_number() OVER (ORDER BY device, subject_id, label, k) - 1 AS seq FROM wk),
last AS (SELECT device, subject_id, max(seq) AS seq FROM sent GROUP BY ALL)
SELECT CASE sent.device WHEN 0 THEN 'phone' ELSE 'watch' END AS device, subject_id, seq, label AS activity, {R6('win.ax')} AS last_x
FROM last JOIN sent USING (device, subject_id, seq)
JOIN win ON win.device = sent.device AND win.subject_id = sent.subject_id AND win.activity = label AND win.k = sent.k AND win.j = 23""",
    "message_progress": _with(STREAM) + """
SELECT c.counter, CASE c.counter WHEN 'sent' THEN n WHEN 'damaged' THEN d WHEN 'read' THEN n + d WHEN 'valid' THEN n ELSE d END AS n
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE seq % 7 = 2) AS d FROM scored) s,
     (VALUES ('sent'), ('damaged'), ('read'), ('valid'), ('dead')) c(counter)""",
    "stream_alert_flags": SQL["alert_flags"],
    "resample_kept": SQL["resample_linear"],
    "paired_subjects": _with(READINGS) + """
SELECT subject_id, device FROM readings GROUP BY ALL HAVING count(DISTINCT sensor) = 2""",
    "histogram_auto": CORE_W + f""",
rule AS (SELECT channel, min(value) AS lo, max(value) AS hi, count(value) AS n,
                2 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / pow(count(value)::DOUBLE, 1.0::DOUBLE / 3) AS width
         FROM wl GROUP BY channel),
rng AS (SELECT channel, lo, hi, CAST(CASE WHEN hi = lo THEN 1 ELSE greatest(ceil(log2(n::DOUBLE) + 1),
               CASE WHEN width > 0 THEN ceil((hi - lo) / width) ELSE 1 END) END AS BIGINT) AS nb FROM rule),
cnt AS (SELECT channel, CAST(CASE WHEN hi - lo = 0 THEN 0
                                  ELSE least(floor((value - lo) / (hi - lo) * nb), nb - 1) END AS INTEGER) AS bin,
               count(*) AS count
        FROM wl JOIN rng USING (channel) WHERE value IS NOT NULL GROUP BY ALL),
bins AS (SELECT channel, lo, hi, nb, CAST(unnest(range(nb)) AS INTEGER) AS bin FROM rng)
SELECT b.channel, b.bin, {R6('lo + b.bin * (hi - lo) / nb')} AS edge_lo,
       {R6('lo + (b.bin + 1) * (hi - lo) / nb')} AS edge_hi, coalesce(c.count, 0) AS count
FROM bins b LEFT JOIN cnt c ON b.channel = c.channel AND b.bin = c.bin""",
    "score_histograms": _with(SCORE) + f""",
vals AS (SELECT 'confidence' AS channel, 30 AS nb, confidence AS value FROM pred UNION ALL
         SELECT 'xentropy', 50, xentropy FROM pred),
rng AS (SELECT channel, nb, min(value) AS lo, max(value) AS hi FROM vals GROUP BY ALL),
cnt AS (SELECT channel, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / (hi - lo) * nb), nb - 1) END AS INTEGER)
               AS bin, count(*) AS count FROM vals JOIN rng USING (channel, nb) GROUP BY ALL),
bins AS (SELECT channel, lo, hi, nb, CAST(unnest(range(nb)) AS INTEGER) AS bin FROM rng)
SELECT b.channel, b.bin, {R6('lo + b.bin * (hi - lo) / nb')} AS edge_lo,
       {R6('lo + (b.bin + 1) * (hi - lo) / nb')} AS edge_hi, coalesce(c.count, 0) AS count
FROM bins b LEFT JOIN cnt c ON b.channel = c.channel AND b.bin = c.bin""",
    "train_windows": CORE + "," + SPLIT + """,
of AS (SELECT subject_id, device, activity, k, avg(ax) AS m FROM win GROUP BY ALL
       HAVING bool_and(ax IS NOT NULL AND ay IS NOT NULL AND gx IS NOT NULL AND gy IS NOT NULL))
SELECT CASE WHEN split = 'train' THEN 'train' ELSE 'held_out' END AS part, count(*) AS n_windows,
       count(DISTINCT m > (SELECT avg(ax) FROM win)) AS n_labels, TRUE AS beats_majority
FROM of JOIN split USING (subject_id) GROUP BY ALL""",
    "stream_scores_windows": CORE + "," + WK + "," + SPLIT + "," + AM + f""",
lettered AS (SELECT w.subject_id, w.device, w.activity, w.k, am.code AS label, s.split = 'train' AS train
             FROM (SELECT DISTINCT subject_id, device, activity, k FROM win) w JOIN split s USING (subject_id)
             JOIN am ON am.pos = CAST(substr(w.activity, 2) AS BIGINT) % (SELECT count(*) FROM am)),
zl AS (""" + " UNION ALL ".join(
        f"SELECT subject_id, device, activity, k, j * 4 + {c} AS d, {ch} AS v FROM zwin"
        for c, ch in enumerate(["ax", "ay", "gx", "gy"])) + f"""),
zv AS (SELECT * FROM zl JOIN lettered USING (subject_id, device, activity, k)),
cent AS (SELECT label AS cls, d, avg(v) AS c FROM zv WHERE train GROUP BY ALL),
sent AS (SELECT *, row_number() OVER (ORDER BY device, subject_id, label, k) - 1 AS seq FROM lettered WHERE NOT train),
dist AS (SELECT z.subject_id, z.device, z.activity, z.k, c.cls, -sum((z.v - c.c) * (z.v - c.c)) AS logit
         FROM zv z JOIN cent c ON z.d = c.d WHERE NOT z.train GROUP BY ALL),
best AS (SELECT subject_id, device, activity, k, max(logit) AS m, arg_min(cls, (-logit, cls)) AS cls FROM dist GROUP BY ALL),
conf AS (SELECT d.subject_id, d.device, d.activity, d.k, b.cls, 1 / sum(exp(d.logit - b.m)) AS confidence
         FROM dist d JOIN best b ON d.subject_id = b.subject_id AND d.device = b.device AND d.activity = b.activity AND d.k = b.k
         GROUP BY ALL)
SELECT seq, CASE s.device WHEN 0 THEN 'phone' ELSE 'watch' END AS device, s.subject_id, s.label AS activity,
       c.cls AS pred_letter, p.name AS pred_name, t.name AS truth_name, {R6('confidence')} AS confidence, c.cls = s.label AS correct
FROM sent s JOIN conf c USING (subject_id, device, activity, k) JOIN am p ON p.code = c.cls JOIN am t ON t.code = s.label""",
    "window_slices": CORE + "," + WK + "," + SPLIT + """
SELECT split, CAST(ceil(count(*) / 200) AS BIGINT) AS n_files, count(*) AS n_windows
FROM wk JOIN split USING (subject_id) GROUP BY split""",
    "resample_clipped": _with(READINGS, CLIPPED) + """
SELECT subject_id, device, activity, sensor, i, n,
       floor((CASE WHEN r = 1 AND i::HUGEINT * (b - a) = (t - a)::HUGEINT * (n - 1) THEN fx
                   ELSE lx + (fx2 - lx) * f END) * 1e6 + 0.5) / 1e6 AS x,
       floor((CASE WHEN r = 1 AND i::HUGEINT * (b - a) = (t - a)::HUGEINT * (n - 1) THEN fy
                   ELSE ly + (fy2 - ly) * f END) * 1e6 + 0.5) / 1e6 AS y FROM pts""",
    "resample_far": _with(READINGS, FAR, BOUNDS, GRID) + """
SELECT subject_id, device, activity, sensor, i, n,
       floor(x * 1e6 + 0.5) / 1e6 AS x, floor(y * 1e6 + 0.5) / 1e6 AS y FROM grid""",
})
