"""Equivalent SQL for the registered queries, written from the definitions of the operators."""

from __future__ import annotations

SQL: dict[str, str] = {}

FX = """fx AS (SELECT user_id AS session_id, event_type AS speaker_id, epoch_us(ts)//1000 AS start_ms,
  epoch_us(ts)//1000 + CAST(floor(value*60000) AS BIGINT) AS end_ms FROM events)"""


def of(name: str, *types: str, cols: str = "session_id, start_ms, end_ms") -> str:
    listed = ", ".join(f"'{t}'" for t in types)
    return f"{name} AS (SELECT {cols} FROM fx WHERE speaker_id IN ({listed}))"


def merged(name: str, src: str, keys: str = "session_id") -> str:
    return f"""{name}_o AS (SELECT {keys}, start_ms, end_ms, max(end_ms) OVER (PARTITION BY {keys}
    ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe
  FROM {src} WHERE end_ms > start_ms),
{name}_i AS (SELECT *, sum(CASE WHEN pe IS NULL OR start_ms > pe THEN 1 ELSE 0 END) OVER (
    PARTITION BY {keys} ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS island FROM {name}_o),
{name} AS (SELECT {keys}, min(start_ms) AS start_ms, max(end_ms) AS end_ms
  FROM {name}_i GROUP BY {keys}, island)"""


def segments(name: str, *sets: str) -> str:
    """Elementary segments with the depth of each set."""
    points = " UNION ".join(
        f"SELECT session_id, start_ms AS t FROM {s} WHERE end_ms > start_ms "
        f"UNION SELECT session_id, end_ms FROM {s} WHERE end_ms > start_ms"
        for s in sets
    )
    depths = ", ".join(
        f"(SELECT count(*) FROM {s} x WHERE x.session_id = g.session_id "
        f"AND x.start_ms <= g.start_ms AND x.end_ms >= g.end_ms) AS d_{s}"
        for s in sets
    )
    return f"""{name}_p AS ({points}),
{name}_g AS (SELECT session_id, t AS start_ms, lead(t) OVER (PARTITION BY session_id ORDER BY t) AS end_ms
  FROM {name}_p),
{name} AS (SELECT g.*, {depths} FROM {name}_g g WHERE end_ms IS NOT NULL)"""


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


OTHERS = ("error", "purchase", "signup", "view")

# ---------------------------------------------------------------- interval algebra

SQL["clean_segments_per_user"] = f"""WITH {FX},
{merged("byspk", "fx", "session_id, speaker_id")},
{segments("seg", "byspk")},
deep AS (SELECT session_id, start_ms, end_ms FROM seg WHERE d_byspk >= 2),
{of("clicks", "click")}, {merged("t", "clicks")},
j AS (SELECT t.*, EXISTS (SELECT 1 FROM deep o WHERE o.session_id = t.session_id
    AND t.start_ms < o.end_ms AND o.start_ms < t.end_ms) AS bad,
  (end_ms - 50) - (start_ms + 50) >= 500 AS kept FROM t)
SELECT session_id, {big("count(*) FILTER (NOT bad AND kept)", "n_clean")},
  {big("count(*) FILTER (bad)", "n_contaminated")},
  {big("count(*) FILTER (NOT bad AND NOT kept)", "n_short")},
  {big("coalesce(sum(end_ms - start_ms - 100) FILTER (NOT bad AND kept), 0)", "clean_ms")},
  {big("coalesce(sum(end_ms - start_ms) FILTER (bad), 0)", "contaminated_ms")}
FROM j GROUP BY session_id"""

SQL["merge_intervals"] = f"""WITH {FX}, {merged("m", "fx")} SELECT * FROM m"""

SQL["merge_intervals_hot_key"] = f"""WITH {FX},
h AS (SELECT CASE WHEN session_id % 3 = 0 THEN 0 ELSE session_id END AS session_id, start_ms, end_ms FROM fx),
{merged("m", "h")} SELECT * FROM m"""

SQL["total_ms"] = f"""WITH {FX}, {merged("m", "fx")}
SELECT session_id, {big("sum(end_ms - start_ms)", "total_ms")} FROM m GROUP BY session_id"""

_CV = f"""WITH {FX}, {of("a0", "click")}, {of("b0", "view")},
{merged("a", "a0")}, {merged("b", "b0")}"""

SQL["interval_intersect"] = f"""{_CV}
SELECT a.session_id, greatest(a.start_ms, b.start_ms) AS start_ms, least(a.end_ms, b.end_ms) AS end_ms
FROM a JOIN b ON a.session_id = b.session_id AND a.start_ms < b.end_ms AND b.start_ms < a.end_ms"""

SQL["interval_subtract"] = f"""{_CV}, {segments("seg", "a", "b")},
left_over AS (SELECT session_id, start_ms, end_ms FROM seg WHERE d_a > 0 AND d_b = 0),
{merged("m", "left_over")} SELECT * FROM m"""

SQL["interval_union"] = f"""WITH {FX}, {of("u", "click", "view")}, {merged("m", "u")} SELECT * FROM m"""

SQL["overlap_regions"] = f"""WITH {FX}, {merged("byspk", "fx", "session_id, speaker_id")},
{segments("seg", "byspk")},
deep AS (SELECT session_id, start_ms, end_ms FROM seg WHERE d_byspk >= 2),
{merged("m", "deep")} SELECT * FROM m"""

SQL["overlap_join"] = f"""WITH {FX}, {of("a", "click")},
{of("b", "error", "view", cols="session_id, speaker_id, start_ms, end_ms")}
SELECT a.session_id, a.start_ms AS a_start_ms, a.end_ms AS a_end_ms, b.speaker_id AS b_speaker_id,
  b.start_ms AS b_start_ms, b.end_ms AS b_end_ms
FROM a JOIN b ON a.session_id = b.session_id AND a.start_ms < b.end_ms AND b.start_ms < a.end_ms
WHERE a.end_ms > a.start_ms AND b.end_ms > b.start_ms"""

SQL["partition_contaminated"] = f"""WITH {FX}, {of("t0", "click")}, {of("o0", *OTHERS)},
{merged("t", "t0")}
SELECT t.*, EXISTS (SELECT 1 FROM o0 o WHERE o.session_id = t.session_id AND o.end_ms > o.start_ms
  AND t.start_ms < o.end_ms AND o.start_ms < t.end_ms) AS contaminated FROM t"""

_AGREE = """agg AS (SELECT session_id,
  coalesce(sum(end_ms - start_ms) FILTER (d_a > 0), 0) AS a_ms,
  coalesce(sum(end_ms - start_ms) FILTER (d_b > 0), 0) AS b_ms,
  coalesce(sum(end_ms - start_ms) FILTER (d_a > 0 AND d_b > 0), 0) AS i_ms,
  coalesce(sum(end_ms - start_ms) FILTER (d_a > 0 OR d_b > 0), 0) AS u_ms
  FROM seg WHERE d_a > 0 OR d_b > 0 GROUP BY session_id)"""

SQL["agreement"] = f"""WITH {FX}, {of("a", "click", "view")}, {of("b", "view", "error")},
{segments("seg", "a", "b")}, {_AGREE}
SELECT session_id, {big("a_ms", "a_ms")}, {big("b_ms", "b_ms")}, {big("i_ms", "intersection_ms")},
  {big("u_ms", "union_ms")}, {big("a_ms - i_ms", "a_only_ms")}, {big("b_ms - i_ms", "b_only_ms")},
  round(CASE WHEN u_ms <> 0 THEN i_ms / u_ms ELSE 0.0::DOUBLE END, 6) AS iou,
  round(CASE WHEN a_ms <> 0 THEN 100.0::DOUBLE * i_ms / a_ms ELSE 0.0 END, 6) AS a_covered_pct,
  round(CASE WHEN b_ms <> 0 THEN 100.0::DOUBLE * i_ms / b_ms ELSE 0.0 END, 6) AS b_covered_pct
FROM agg"""

SQL["interval_iou"] = f"""WITH {FX}, {of("a", "purchase")}, {of("b", "signup")},
{segments("seg", "a", "b")}, {_AGREE}
SELECT session_id, round(CASE WHEN u_ms <> 0 THEN i_ms / u_ms ELSE 0.0::DOUBLE END, 6) AS iou FROM agg"""

_RECORDED = """rec AS (SELECT session_id, start_ms, end_ms,
  (end_ms - start_ms + 500) // 1000 * 1000 AS duration_ms
  FROM fx WHERE speaker_id = 'click' AND end_ms > start_ms)"""

SQL["segment_agreement"] = f"""WITH {FX}, {_RECORDED}, {of("c0", *OTHERS)}, {merged("c", "c0")},
n AS (SELECT *, row_number() OVER () AS id FROM rec),
cov AS (SELECT n.id, sum(least(n.end_ms, c.end_ms) - greatest(n.start_ms, c.start_ms)) AS ms
  FROM n JOIN c ON n.session_id = c.session_id AND n.start_ms < c.end_ms AND c.start_ms < n.end_ms
  GROUP BY n.id),
p AS (SELECT n.*, {big("coalesce(ms, 0)", "covered_ms")} FROM n LEFT JOIN cov USING (id)),
q AS (SELECT *, CASE WHEN duration_ms <> 0 THEN 100.0::DOUBLE * covered_ms / duration_ms ELSE 0.0 END AS f FROM p)
SELECT session_id, start_ms, end_ms, duration_ms, covered_ms, round(f, 6) AS covered_pct,
  CASE WHEN f >= 80 THEN 'AGREE' WHEN f >= 20 THEN 'PARTIAL' ELSE 'MISS' END AS verdict FROM q"""

SQL["segment_ordinals"] = f"""WITH {FX}, {_RECORDED}
SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY start_ms, end_ms) AS ordinal FROM rec"""

SQL["vector_ranks"] = """SELECT label AS session_id, vec_id,
  rank() OVER (PARTITION BY label ORDER BY vec_id // 10) AS rank, CAST(len(embedding) AS INTEGER) AS dim FROM embeddings"""

SQL["model_batches"] = """SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ ]+')) AS BIGINT) AS n_words,
  text[1:3] AS head FROM documents"""

_MATCH = f"""{of("t0", "click")}, {merged("t", "t0")},
{of("s0", *OTHERS, cols="session_id, speaker_id, start_ms, end_ms")},
{merged("s", "s0", "session_id, speaker_id")},
ov AS (SELECT s.session_id, s.speaker_id,
  coalesce(sum(least(s.end_ms, t.end_ms) - greatest(s.start_ms, t.start_ms))
    FILTER (t.session_id IS NOT NULL), 0) AS ms
  FROM s LEFT JOIN t ON s.session_id = t.session_id AND s.start_ms < t.end_ms AND t.start_ms < s.end_ms
  GROUP BY s.session_id, s.speaker_id),
best AS (SELECT session_id, speaker_id, {big("ms", "overlap_ms")} FROM ov
  QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY ms DESC, speaker_id) = 1)"""

SQL["match_best_overlap"] = f"WITH {FX}, {_MATCH} SELECT * FROM best"

SQL["speaker_inventory"] = f"""WITH {FX}, {_MATCH},
inv AS (SELECT session_id, speaker_id, {big("sum(end_ms - start_ms)", "speech_ms")},
  count(*) AS n_turns FROM s GROUP BY session_id, speaker_id)
SELECT inv.*, inv.speaker_id = best.speaker_id AS matched FROM inv JOIN best USING (session_id)
""".replace("inv.*, inv.speaker_id", "inv.session_id, inv.speaker_id, speech_ms, n_turns, inv.speaker_id")

SQL["session_bounds"] = f"""WITH {FX},
b AS (SELECT session_id, min(start_ms) AS t0, max(end_ms) AS t1 FROM fx
  WHERE speaker_id IN ('click', 'view') GROUP BY session_id)
SELECT c_custkey AS session_id, coalesce(t0, 0) AS t0_ms, coalesce(t1, 1) AS t1_ms
FROM customer LEFT JOIN b ON session_id = c_custkey"""

_LANES = f"""WITH {FX}, l AS (SELECT session_id, speaker_id AS lane, start_ms, end_ms FROM fx
  WHERE speaker_id IN ('click', 'view')),
b AS (SELECT session_id, min(start_ms) AS t0, max(end_ms) - min(start_ms) AS span FROM l GROUP BY session_id),
grid AS (SELECT DISTINCT l.session_id, lane, c.col, t0 + (span * c.col) // 40 AS c0,
  greatest(t0 + (span * (c.col + 1)) // 40, t0 + (span * c.col) // 40 + 1) AS c1
  FROM l JOIN b USING (session_id), (SELECT unnest(range(0, 40)) AS col) c),
lanes AS (SELECT session_id, lane, col, EXISTS (SELECT 1 FROM l WHERE l.session_id = grid.session_id
    AND l.lane = grid.lane AND l.end_ms > l.start_ms AND l.start_ms < c1 AND l.end_ms > c0) AS active FROM grid)"""

SQL["bucket_lanes"] = f"{_LANES} SELECT * FROM lanes"

SQL["bucket_diff"] = f"""{_LANES},
w AS (SELECT session_id, col, coalesce(bool_or(active) FILTER (lane = 'click'), false) AS a,
  coalesce(bool_or(active) FILTER (lane = 'view'), false) AS b FROM lanes GROUP BY session_id, col)
SELECT session_id, col, CASE WHEN a AND b THEN 'both' WHEN a THEN 'a' WHEN b THEN 'b' ELSE 'neither' END AS verdict
FROM w"""

# ---------------------------------------------------------------- clocks, windows, masks

_CLIPS = """clips AS (SELECT conv_id AS session_id, CAST(turn AS INTEGER) AS file_index, role AS source,
  CAST(length(text) * 10 AS BIGINT) AS duration_ms FROM conversations),
clock AS (SELECT *, CAST(coalesce(sum(duration_ms) OVER (PARTITION BY session_id ORDER BY file_index
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset_ms FROM clips)"""

SQL["session_clock"] = f"""WITH {_CLIPS}
SELECT session_id, file_index, duration_ms, offset_ms FROM clock"""

SQL["turns_on_session_clock"] = f"""WITH {_CLIPS}
SELECT session_id, file_index, offset_ms AS start_ms, offset_ms + duration_ms AS end_ms, source, duration_ms
FROM clock"""

SQL["window_schedule"] = f"""WITH {_CLIPS},
w AS (SELECT *, unnest(CASE WHEN duration_ms <= 0 THEN []
  WHEN duration_ms <= 10000 THEN [0::BIGINT]
  ELSE list_append(range(0, duration_ms - 10000, 5000), duration_ms - 10000) END) AS s FROM clips)
SELECT session_id, file_index, source, duration_ms, s AS window_start_ms,
  least(s + 10000, duration_ms) AS window_end_ms FROM w"""

SQL["sample_points"] = f"""WITH {_CLIPS},
i AS (SELECT session_id, file_index, file_index::BIGINT * 7 AS start_ms,
  file_index::BIGINT * 7 + duration_ms AS end_ms FROM clips)
SELECT *, unnest(CASE WHEN start_ms + 125 < end_ms THEN range(start_ms + 125, end_ms, 250)
  ELSE [(start_ms + end_ms) // 2] END) AS pts_ms FROM i"""

_MASKS = """ev AS (SELECT user_id AS session_id, (epoch_us(ts)//1000)//86400000 AS day, event_type,
  (epoch_us(ts)//1000)%86400000//900000 AS f FROM events),
spk AS (SELECT session_id, day, event_type, CAST(row_number() OVER (PARTITION BY session_id, day
  ORDER BY event_type) - 1 AS INTEGER) AS speaker_idx
  FROM (SELECT DISTINCT session_id, day, event_type FROM ev)),
hits AS (SELECT DISTINCT session_id, day, event_type, f FROM ev),
cells AS (SELECT s.session_id, s.day * 86400000 AS window_start_ms, s.speaker_idx,
  CAST(g.f AS INTEGER) AS frame, h.f IS NOT NULL AS active
  FROM spk s CROSS JOIN (SELECT unnest(range(0, 96)) AS f) g
  LEFT JOIN hits h ON h.session_id = s.session_id AND h.day = s.day AND h.event_type = s.event_type AND h.f = g.f)"""

SQL["frames_of"] = f"""WITH {_MASKS}
SELECT session_id, window_start_ms, speaker_idx, frame, CAST(active AS TINYINT) AS active FROM cells"""

SQL["mask_runs"] = f"""WITH {_MASKS},
a AS (SELECT *, frame - row_number() OVER (PARTITION BY session_id, window_start_ms, speaker_idx ORDER BY frame) AS g
  FROM cells WHERE active),
r AS (SELECT session_id, window_start_ms, speaker_idx, min(frame) AS f0, max(frame) AS f1
  FROM a GROUP BY session_id, window_start_ms, speaker_idx, g)
SELECT session_id, window_start_ms, speaker_idx, CAST(row_number() OVER (PARTITION BY session_id,
  window_start_ms, speaker_idx ORDER BY f0) - 1 AS INTEGER) AS run,
  window_start_ms + f0::BIGINT * 900000 AS start_ms, window_start_ms + (f1::BIGINT + 1) * 900000 AS end_ms FROM r"""

SQL["frame_depth"] = f"""WITH {_MASKS}
SELECT session_id, window_start_ms, frame, {big("sum(active::INTEGER)", "depth")},
  sum(active::INTEGER) >= 2 AS overlapped FROM cells GROUP BY session_id, window_start_ms, frame"""

SQL["window_overlaps"] = f"""WITH {_MASKS},
d AS (SELECT session_id, window_start_ms, frame FROM cells WHERE active
  GROUP BY session_id, window_start_ms, frame HAVING count(*) >= 2),
a AS (SELECT *, frame - row_number() OVER (PARTITION BY session_id, window_start_ms ORDER BY frame) AS g FROM d)
SELECT session_id, window_start_ms, window_start_ms + min(frame)::BIGINT * 900000 AS start_ms,
  window_start_ms + (max(frame)::BIGINT + 1) * 900000 AS end_ms
FROM a GROUP BY session_id, window_start_ms, g"""

SQL["active_speakers"] = f"""WITH {_MASKS}
SELECT session_id, window_start_ms, speaker_idx, {big("sum(active::INTEGER) * 900000", "active_ms")}
FROM cells GROUP BY session_id, window_start_ms, speaker_idx HAVING sum(active::INTEGER) >= 2"""

SQL["time_conversions"] = """WITH e AS (SELECT *, epoch_us(ts) - 1704067200000000 - 864000000000 AS x FROM events),
y AS (SELECT *, x::HUGEINT * 1000 + 45000 AS n, event_id * 37 - 5000 AS c FROM e)
SELECT event_id,
  CAST(CASE WHEN n >= 0 OR n % 90000 = 0 THEN n // 90000 ELSE n // 90000 - 1 END AS BIGINT) AS ticks_ms,
  ((event_id * 7 + 3) * 1000 + 22050) // 44100 AS samples_ms,
  event_id * 11 * 44100 // 1000 AS ms_samples,
  CAST(round_even((value + 0.0005) * 1000.0, 0) AS BIGINT) AS seconds_ms,
  CASE WHEN c < 0 THEN '-' ELSE '' END || CASE WHEN abs(c) // 60000 < 10 THEN '0' ELSE '' END
    || (abs(c) // 60000)::VARCHAR || ':' || lpad((abs(c) // 1000 % 60)::VARCHAR, 2, '0') || '.'
    || lpad((abs(c) % 1000)::VARCHAR, 3, '0') AS clock_text,
  round(CASE WHEN event_id % 7 <> 0 THEN 100.0::DOUBLE * event_id / (event_id % 7) ELSE 0.0 END, 6) AS share,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(((epoch_us(ts) // 1000) % 1000)::VARCHAR, 3, '0') || 'Z' AS stamp
FROM y"""

# ---------------------------------------------------------------- identity

_VEC = """vec AS (SELECT label AS session_id, vec_id // 10 AS window_start_ms,
  CAST(vec_id % 10 AS INTEGER) AS speaker_idx, vec_id, embedding::DOUBLE[] AS e,
  sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS nrm FROM embeddings),
unit AS (SELECT session_id, unnest(range(0, len(e))) AS i, unnest(e) / CASE WHEN nrm = 0 THEN 1 ELSE nrm END AS x FROM vec),
mean AS (SELECT session_id, i, avg(x) AS m FROM unit GROUP BY session_id, i),
seed AS (SELECT session_id, list(m ORDER BY i) AS s, sqrt(sum(m * m)) AS sn FROM mean GROUP BY session_id),
cosn AS (SELECT vec.*, list_dot_product(e, s) / (nrm * sn) AS c FROM vec JOIN seed USING (session_id))"""

SQL["pool_vectors"] = f"""WITH {_VEC}, n AS (SELECT session_id, count(*) AS n_vectors FROM vec GROUP BY session_id)
SELECT session_id, n_vectors, CAST(i AS INTEGER) AS i, round(m / sn, 6) + 0.0 AS x
FROM mean JOIN seed USING (session_id) JOIN n USING (session_id)"""

SQL["vector_cosine"] = f"""WITH {_VEC}
SELECT vec_id, round(nrm, 6) + 0.0 AS norm, round(c, 6) + 0.0 AS cosine FROM cosn"""

SQL["match_identity"] = f"""WITH {_VEC},
k AS (SELECT session_id, window_start_ms, speaker_idx, c, row_number() OVER (PARTITION BY session_id, window_start_ms
  ORDER BY c DESC, speaker_idx) AS rn FROM cosn WHERE c >= 0.20)
SELECT g.session_id, g.window_start_ms, k.speaker_idx AS target_speaker_idx,
  round(coalesce(k.c, 0.0::DOUBLE), 6) + 0.0 AS target_cosine
FROM (SELECT DISTINCT session_id, window_start_ms FROM vec) g
LEFT JOIN k ON k.session_id = g.session_id AND k.window_start_ms = g.window_start_ms AND k.rn = 1"""

_FACES = """faces AS (SELECT l_suppkey AS session_id, l_orderkey % 2000 * 250 + 125 AS pts_ms,
  [l_quantity, l_discount * 100, l_tax * 100] AS e FROM lineitem),
refs AS (SELECT s_suppkey AS session_id, [30.0::DOUBLE, (s_nationkey % 11)::DOUBLE, 4.0::DOUBLE] AS t,
  CASE WHEN s_suppkey % 2 = 1 THEN [1.0::DOUBLE, 10.0::DOUBLE, 10.0::DOUBLE] END AS a FROM supplier),
scored AS (SELECT f.session_id, pts_ms,
  list_dot_product(e, t) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(t, t))) AS ct,
  list_dot_product(e, a) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(a, a))) AS ca
  FROM faces f JOIN refs USING (session_id)),
hit AS (SELECT *, ct >= 0.9 AND (ca IS NULL OR ca < ct) AS h FROM scored),
frames AS (SELECT session_id, pts_ms, count(*) AS n_faces, bool_or(h) AS target_seen,
  count(*) = 1 AND bool_or(h) AS clean FROM hit GROUP BY session_id, pts_ms)"""

SQL["target_test"] = f"""WITH {_FACES}
SELECT session_id, count(*) AS n_faces,
  count(*) FILTER (round(ct, 6) >= 0.9 AND (ca IS NULL OR round(ca, 6) < round(ct, 6))) AS n_target
FROM scored GROUP BY session_id"""

_BOXES = """boxes AS (SELECT l_orderkey AS pts_ms, CAST(l_partkey % 400 AS INTEGER) AS x1,
  CAST(l_suppkey * 3 AS INTEGER) AS y1, CAST(trunc(l_partkey % 400 + l_quantity * 8) AS INTEGER) AS x2,
  CAST(trunc(l_suppkey * 3 + l_quantity * 6) AS INTEGER) AS y2, l_discount AS score FROM lineitem),
idx AS (SELECT *, row_number() OVER (PARTITION BY pts_ms ORDER BY x1, y1, x2, y2, score) - 1 AS box_idx FROM boxes)"""


def iou(a: str, b: str) -> str:
    inter = (
        f"(greatest(0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1))::BIGINT"
        f" * greatest(0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)))"
    )
    area = lambda p: f"(greatest(0, {p}.x2 - {p}.x1)::BIGINT * greatest(0, {p}.y2 - {p}.y1))"
    return (
        f"CASE WHEN {inter} > 0 THEN {inter}::DOUBLE / ({area(a)} + {area(b)} - {inter}) ELSE 0.0 END"
    )


SQL["box_geometry"] = f"""WITH {_BOXES}, fixed AS (SELECT 100 AS x1, 50 AS y1, 300 AS x2, 250 AS y2)
SELECT boxes.pts_ms, {big("sum(greatest(0, boxes.x2 - boxes.x1)::BIGINT * greatest(0, boxes.y2 - boxes.y1))", "area")},
  round(max({iou("boxes", "fixed")}), 6) AS best_iou,
  count(*) FILTER (200 BETWEEN boxes.x1 AND boxes.x2 AND 150 BETWEEN boxes.y1 AND boxes.y2) AS n_holding
FROM boxes, fixed GROUP BY boxes.pts_ms"""

SQL["box_order"] = f"WITH {_BOXES} SELECT * FROM idx"

SQL["resolve_clicks"] = f"""WITH {_BOXES},
c AS (SELECT o_orderkey AS pts_ms, CAST(o_custkey % 600 AS INTEGER) AS x, CAST(o_orderkey * 7 % 450 AS INTEGER) AS y
  FROM orders),
n AS (SELECT pts_ms, count(*) AS n FROM boxes GROUP BY pts_ms),
h AS (SELECT c.pts_ms, b.x1, b.y1, b.x2, b.y2, b.score, row_number() OVER (PARTITION BY c.pts_ms ORDER BY
    (b.x2 - b.x1)::BIGINT * (b.y2 - b.y1), b.x1, b.y1, b.x2, b.y2, b.score) AS rn
  FROM c JOIN boxes b ON b.pts_ms = c.pts_ms AND c.x BETWEEN b.x1 AND b.x2 AND c.y BETWEEN b.y1 AND b.y2)
SELECT c.*, h.x1, h.y1, h.x2, h.y2, h.score, coalesce(n.n, 0) AS n_boxes
FROM c LEFT JOIN h ON h.pts_ms = c.pts_ms AND h.rn = 1 LEFT JOIN n ON n.pts_ms = c.pts_ms"""

SQL["associate_boxes"] = f"""WITH {_BOXES},
ob AS (SELECT l_orderkey AS pts_ms, CAST(l_partkey % 400 + l_linenumber * 4 AS INTEGER) AS x1,
  CAST(l_suppkey * 3 + l_linenumber * 4 AS INTEGER) AS y1,
  CAST(trunc(l_partkey % 400 + l_linenumber * 4 + l_quantity * 7) AS INTEGER) AS x2,
  CAST(trunc(l_suppkey * 3 + l_linenumber * 4 + l_quantity * 7) AS INTEGER) AS y2, l_tax AS score FROM lineitem),
oi AS (SELECT *, row_number() OVER (PARTITION BY pts_ms ORDER BY x1, y1, x2, y2, score) - 1 AS box_idx FROM ob),
p AS (SELECT a.pts_ms, a.box_idx, b.box_idx AS o, {iou("a", "b")} AS v FROM idx a JOIN oi b ON a.pts_ms = b.pts_ms),
best AS (SELECT *, row_number() OVER (PARTITION BY pts_ms, box_idx ORDER BY v DESC, o) AS rn FROM p)
SELECT pts_ms, box_idx, CASE WHEN v >= 0.3 THEN o END AS other_box_idx, round(v, 6) AS iou, v >= 0.3 AS associated
FROM best WHERE rn = 1"""

SQL["frame_identity"] = f"WITH {_FACES} SELECT * FROM frames"

_CLEAN = f"""{_FACES},
speech AS (SELECT DISTINCT l_suppkey AS session_id, l_partkey % 1990 * 250 AS start_ms,
  l_partkey % 1990 * 250 + (l_linenumber % 3 + 1) * 250 AS end_ms FROM lineitem),
pts AS (SELECT *, unnest(range(start_ms + 125, end_ms, 250)) AS pts_ms FROM speech),
cw AS (SELECT p.session_id, p.start_ms, p.end_ms FROM pts p
  LEFT JOIN frames f ON f.session_id = p.session_id AND f.pts_ms = p.pts_ms
  GROUP BY p.session_id, p.start_ms, p.end_ms HAVING bool_and(coalesce(f.clean, false)))"""

SQL["clean_windows"] = f"WITH {_CLEAN} SELECT * FROM cw"

SQL["seed_guard"] = f"""WITH {_CLEAN},
g AS (SELECT s_suppkey AS session_id, count(cw.start_ms) AS n_windows,
  {big("coalesce(sum(end_ms - start_ms), 0)", "total_ms")}
  FROM supplier LEFT JOIN cw ON cw.session_id = s_suppkey GROUP BY s_suppkey)
SELECT *, CASE WHEN n_windows = 0 THEN 'no clean single-target enrollment windows found'
  WHEN total_ms < 40000 THEN 'clean enrollment audio below seed_min_ms' END AS reason FROM g"""

# ---------------------------------------------------------------- audit logs

_LOG = """recs AS (SELECT user_id AS session_id, event_id, epoch_us(ts) AS ts_us,
  row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) - 1 AS seq,
  event_type AS operation, replace(props, ': ', ':') AS payload,
  '{"timestamp_utc":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.')
    || lpad(((epoch_us(ts) // 1000) % 1000)::VARCHAR, 3, '0') || 'Z"}' AS audit FROM events)"""

SQL["chain_build"] = f"""WITH RECURSIVE {_LOG},
h AS (SELECT *, sha256(payload) AS payload_sha256 FROM recs),
chain AS (SELECT session_id, seq, operation, repeat('0', 64) AS prev_sha256, payload_sha256,
    sha256(repeat('0', 64) || payload_sha256 || seq::VARCHAR || operation || audit) AS entry_sha256
  FROM h WHERE seq = 0
  UNION ALL
  SELECT h.session_id, h.seq, h.operation, c.entry_sha256, h.payload_sha256,
    sha256(c.entry_sha256 || h.payload_sha256 || h.seq::VARCHAR || h.operation || h.audit)
  FROM chain c JOIN h ON h.session_id = c.session_id AND h.seq = c.seq + 1)
SELECT * FROM chain"""

SQL["chain_verify"] = f"""WITH {_LOG},
n AS (SELECT session_id, session_id % 5 AS kind, count(*) AS n FROM recs GROUP BY session_id)
SELECT session_id, CASE WHEN kind = 2 AND n > 7 THEN n - 1 ELSE n END AS n_records,
  NOT ((kind IN (0, 1, 3) AND n > 7) OR (kind = 2 AND n > 8)) AS valid,
  CASE WHEN NOT valid THEN 7::BIGINT END AS broken_index,
  CASE WHEN NOT valid THEN CASE WHEN kind = 2 THEN 8::BIGINT ELSE 7::BIGINT END END AS broken_seq,
  CASE WHEN NOT valid THEN CASE kind WHEN 0 THEN 'payload hash mismatch' WHEN 2 THEN 'prev_sha256 mismatch'
    ELSE 'entry hash mismatch' END END AS reason FROM n"""

SQL["diff_runs"] = f"""WITH {_LOG}
SELECT session_id, seq, sha256(payload) AS a_payload_sha256, sha256('{{"k":777}}') AS b_payload_sha256
FROM recs WHERE session_id % 5 = 0 AND event_id % 13 = 0"""

SQL["output_fingerprint"] = f"""WITH {_LOG}
SELECT session_id, count(*) AS n_outputs,
  sha256('["' || string_agg(sha256(payload), '","' ORDER BY sha256(payload)) || '"]') AS output_fingerprint
FROM recs GROUP BY session_id"""

SQL["log_completeness"] = f"""WITH {_LOG},
s AS (SELECT session_id, list(DISTINCT operation) AS ops, arg_max(operation, seq) AS last_operation
  FROM recs GROUP BY session_id)
SELECT session_id, array_to_string(list_filter(['click', 'error', 'purchase', 'signup', 'view'],
  lambda x: NOT list_contains(ops, x)), ',') AS missing, last_operation, false AS complete FROM s"""

_NESTED = """e AS (SELECT user_id AS session_id, event_id AS seq, epoch_us(ts)//1000 AS ms,
  CASE WHEN event_id % 4 = 0 THEN 'layer3_segment' ELSE event_type END AS operation,
  CASE WHEN event_id % 16 = 0 THEN '"n/a"' ELSE (epoch_us(ts)//1000 + event_id % 500 - 20)::VARCHAR END AS en FROM events),
nested AS (SELECT *, '{"end_global_ms":' || en || ',"start_global_ms":' || ms || '}' AS body,
  CASE WHEN seq % 12 = 5 THEN 'other' ELSE operation END AS inner_op FROM e)"""

SQL["unwrap_records"] = f"""WITH {_NESTED}
SELECT seq, operation, CASE WHEN seq % 3 = 0 OR inner_op = operation THEN body
  ELSE '{{"file_index":0,"operation":"' || inner_op || '","payload":' || body || ',"start_ms":' || ms || '}}' END AS payload
FROM nested"""

SQL["extract_segments"] = f"""WITH {_NESTED},
s AS (SELECT session_id, seq, ms AS start_ms, TRY_CAST(en AS BIGINT) AS end_ms FROM nested
  WHERE operation = 'layer3_segment' AND (seq % 3 = 0 OR inner_op = operation))
SELECT *, end_ms - start_ms AS duration_ms, 'CLEAN' AS decision FROM s WHERE end_ms > start_ms"""

SQL["canonical_strings"] = """SELECT doc_id, sha256(text) AS text_sha256,
  CAST(length(to_json(text)::VARCHAR) AS BIGINT) AS encoded_length FROM documents"""

SQL["redact_text"] = """WITH d AS (SELECT *, CASE WHEN lang = 'en' THEN 'the' ELSE 'de' END AS token FROM documents)
SELECT doc_id, CAST((length(text) - length(regexp_replace(text, token, '', 'gi'))) // length(token) AS BIGINT) AS n_redacted,
  sha256(regexp_replace(text, token, '[x]', 'gi')) AS redacted_sha256 FROM d"""

# ---------------------------------------------------------------- registries and clips

_REG = """reg AS (SELECT 'doc' || doc_id AS name,
  CASE WHEN doc_id % 70 = 69 THEN 'gone' ELSE lang END || '/' || doc_id || '.txt' AS path, doc_id,
  CASE WHEN doc_id % 70 <> 69 THEN sha256(text) END AS actual,
  CASE WHEN doc_id % 50 = 49 THEN sha256(sha256(text)) WHEN doc_id % 90 = 89 THEN '' ELSE sha256(text) END AS expected
  FROM documents)"""

SQL["build_registry"] = f"WITH {_REG} SELECT name, path, actual AS sha256 FROM reg"

SQL["verify_registry"] = f"""WITH {_REG},
need AS (SELECT DISTINCT CASE WHEN quality = 1 THEN 'doc' ELSE 'model' END || doc_id AS name FROM labels)
SELECT name, path, expected, actual, CASE WHEN actual IS NULL THEN 'MISSING' WHEN expected = '' THEN 'NO-HASH'
  WHEN actual <> expected THEN 'MISMATCH' ELSE 'OK' END AS status FROM reg
UNION ALL
SELECT name, NULL, '', NULL, 'REQUIRED' FROM need WHERE name NOT IN (SELECT name FROM reg)"""

SQL["missing_names"] = f"""WITH {_REG}
SELECT DISTINCT CASE WHEN toxic = 1 THEN 'doc' ELSE 'model' END || doc_id AS name FROM labels
WHERE name NOT IN (SELECT name FROM reg)"""

SQL["turns_from_seconds"] = """SELECT event_id, user_id::VARCHAR AS speaker_id,
  CAST(round_even((value + 0.0005) * 1000.0, 0) AS BIGINT) AS start_ms,
  CAST(round_even(value * 3 * 1000.0, 0) AS BIGINT) AS end_ms FROM events"""

SQL["registry_documents"] = f"WITH {_REG} SELECT name, path, expected AS sha256 FROM reg"

SQL["click_documents"] = """WITH c AS (SELECT o_orderkey::VARCHAR AS session_id, 0::INTEGER AS file_index,
  CAST(o_custkey % 600 AS INTEGER) AS x, CAST(o_orderkey * 7 % 450 AS INTEGER) AS y, o_orderkey AS pts_ms FROM orders)
SELECT session_id, 'speaking' AS kind, file_index, x, y, pts_ms FROM c
UNION ALL
SELECT session_id, 'anti', file_index, x + 5, y, pts_ms FROM c WHERE pts_ms % 3 = 0"""

SQL["click_failures"] = """SELECT o_orderkey AS session_id,
  CASE WHEN o_orderkey % 5 = 0 THEN 'speaking' END AS kind,
  CAST(CASE WHEN o_orderkey % 5 = 0 THEN 0 END AS INTEGER) AS file_index,
  CAST(CASE WHEN o_orderkey % 5 = 0 THEN 1 END AS INTEGER) AS x, CAST(CASE WHEN o_orderkey % 5 = 0 THEN 2 END AS INTEGER) AS y,
  CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey + 9007199254740993 END AS pts_ms,
  CASE o_orderkey % 5 WHEN 3 THEN 'not a JSON object' WHEN 4 THEN 'not valid JSON' WHEN 0 THEN NULL
    ELSE 'malformed click: speaking_click' END AS reason FROM orders"""

SQL["read_turns"] = """WITH o AS (SELECT o_orderkey AS k, o_orderkey::VARCHAR AS t, o_custkey % 50 AS p, o_orderkey % 11 AS r,
  o_orderkey % 7 = 3 AS bad FROM orders)
SELECT 's' || t AS session_id, 'a' AS speaker_id, k AS start_ms, k + p AS end_ms, NULL AS reason
FROM o WHERE r NOT IN (5, 6, 7, 8) AND NOT bad AND p > 0
UNION ALL SELECT 's' || t, '12', k, k + 5, NULL FROM o WHERE r NOT IN (5, 6, 7, 8) AND NOT bad
UNION ALL SELECT 's' || t, NULL, NULL, NULL, 'malformed segment {"end_ms":null,"speaker_id":12,"start_ms":' || t || '.9}'
FROM o WHERE r NOT IN (5, 6, 7, 8) AND bad
UNION ALL SELECT t, NULL, NULL, NULL, CASE r WHEN 5 THEN 'not valid JSON' WHEN 6 THEN 'not a JSON object' ELSE 'segments is no list' END
FROM o WHERE r IN (5, 6, 7)"""

SQL["turns_round_trip"] = f"""WITH {_CLIPS}
SELECT session_id::VARCHAR AS session_id, source AS speaker_id, offset_ms AS start_ms, offset_ms + duration_ms AS end_ms FROM clock"""

SQL["turns_documents"] = f"""WITH {_CLIPS},
t AS (SELECT session_id, source AS speaker_id, offset_ms AS start_ms, offset_ms + duration_ms AS end_ms FROM clock),
h AS (SELECT session_id, count(*) AS n, count(DISTINCT speaker_id) AS k, sum(end_ms - start_ms) AS ms,
  min(speaker_id) AS s0, min({{'a': start_ms, 'b': end_ms, 'c': speaker_id}}) AS f FROM t GROUP BY session_id),
nul AS (SELECT NULL::BIGINT AS z)
SELECT session_id, 0 AS part, z AS start_ms, z AS end_ms, '{{"num_segments":' || n || ',"num_speakers":' || k
  || ',"schema":"turns-output-v1","session_id":"' || session_id || '","total_speech_ms":' || ms || ',"speakers":[' AS line
FROM h, nul
UNION ALL
SELECT session_id, 1, z, z, CASE WHEN speaker_id = s0 THEN '' ELSE ',' END || '"' || speaker_id || '"'
FROM (SELECT DISTINCT session_id, speaker_id FROM t) JOIN h USING (session_id), nul
UNION ALL SELECT session_id, 2, z, z, '],"segments":[' FROM h, nul
UNION ALL
SELECT session_id, 3, start_ms, end_ms, CASE WHEN row_number() OVER (PARTITION BY session_id
    ORDER BY start_ms, end_ms, speaker_id) = 1 THEN '' ELSE ',' END
  || '{{"end_ms":' || end_ms || ',"speaker_id":"' || speaker_id || '","start_ms":' || start_ms || '}}' FROM t
UNION ALL SELECT session_id, 4, z, z, ']}}' FROM h, nul"""

_CUT = """p AS (SELECT source AS session_id, CAST(doc_id AS INTEGER) AS file_index, encode(text) AS raw,
  octet_length(encode(text)) // 2 AS n FROM documents),
q AS (SELECT *, (n * 1000 + 4000) // 8000 AS total FROM p),
r AS (SELECT *, total // 4 AS s, total * 3 // 4 AS e FROM q),
u AS (SELECT *, s * 8 AS s0, e * 8 - s * 8 AS cnt FROM r),
v AS (SELECT *, raw[2 * s0 + 1 : 2 * (s0 + cnt)] AS pcm FROM u),
le AS (SELECT *, octet_length(pcm) AS b FROM v),
w AS (SELECT *, 'target_f' || lpad(file_index::VARCHAR, CAST(greatest(3, length(file_index::VARCHAR)) AS INTEGER), '0') || '_' || lpad((s + file_index::BIGINT * 100)::VARCHAR, 9, '0')
    || '-' || lpad((e + file_index::BIGINT * 100)::VARCHAR, 9, '0') || '.wav' AS name,
  'RIFF'::BLOB || unhex(LE1) || 'WAVEfmt '::BLOB || unhex('1000000001000100401f0000803e00000200100064617461')
    || unhex(LE2) || pcm AS wav FROM le)"""


def _le(expr: str) -> str:
    h = f"lpad(hex({expr}), 8, '0')"
    return f"{h}[7:8] || {h}[5:6] || {h}[3:4] || {h}[1:2]"


_CUT = _CUT.replace("LE1", _le("b + 36")).replace("LE2", _le("b"))

SQL["cut_clips"] = f"""WITH {_CUT}
SELECT session_id, file_index, name, octet_length(wav) AS n_bytes, sha256(wav) AS sha256 FROM w"""

SQL["export_wav_files"] = SQL["cut_clips"]

SQL["slices_from_files"] = f"""WITH {_CUT}
SELECT session_id, file_index, b // 2 AS valid_samples, sha256(pcm) AS sha256 FROM w"""

SQL["parse_wavs"] = f"""WITH {_CUT}
SELECT name AS path, 8000 AS sample_rate, 1 AS channels, b // 2 AS n_frames,
  (b // 2 * 1000 + 4000) // 8000 AS duration_ms, sha256(wav) AS sha256 FROM w"""

SQL["feature_mean"] = """WITH f AS (SELECT vec_id // 10 AS w, embedding::DOUBLE[] AS e,
  row_number() OVER (PARTITION BY vec_id // 10 ORDER BY vec_id) AS k,
  count(*) OVER (PARTITION BY vec_id // 10) AS n FROM embeddings),
g AS (SELECT *, greatest(1, least(n, (w % 13 * 320 + 100) // 320)) AS keep FROM f),
x AS (SELECT w, keep, unnest(range(0, len(e))) AS i, unnest(e) AS v FROM g WHERE k <= keep)
SELECT w AS window_start_ms, keep AS n_frames, CAST(i AS INTEGER) AS i, round(sum(v) / keep, 6) + 0.0 AS x
FROM x GROUP BY w, keep, i"""
