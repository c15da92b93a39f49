"""Equivalent SQL for the composite jobs, log files and the stream."""

from __future__ import annotations

from workload.oracles import _CLIPS, _LANES, _LOG, _NESTED, FX, OTHERS, SQL, big, merged, of

SQL["preprocess_sessions"] = f"""WITH {_CLIPS},
n AS (SELECT session_id, file_index, offset_ms, duration_ms * 8 AS n FROM clock),
s AS (SELECT session_id, file_index, offset_ms, n // 8 AS a, n // 2 AS b FROM n
  UNION ALL SELECT session_id, file_index, offset_ms, n // 3, n * 3 // 4 FROM n
  UNION ALL SELECT session_id, file_index, offset_ms, n * 7 // 8, n FROM n),
loc AS (SELECT session_id, offset_ms + (a * 1000 + 4000) // 8000 AS start_ms,
  offset_ms + (b * 1000 + 4000) // 8000 AS end_ms FROM s),
{merged("g", "loc")},
t AS (SELECT session_id, sum(end_ms - start_ms) AS ms FROM g GROUP BY session_id)
SELECT c.session_id, count(*) AS n_files, {big("sum(duration_ms)", "session_ms")},
  {big("coalesce(max(ms), 0)", "speech_ms")}
FROM clips c LEFT JOIN t ON t.session_id = c.session_id GROUP BY c.session_id"""

SQL["track_sessions"] = f"""WITH {_CLIPS},
w AS (SELECT session_id, file_index, duration_ms, unnest(CASE WHEN duration_ms <= 0 THEN []
  WHEN duration_ms <= 10000 THEN [0::BIGINT]
  ELSE list_append(range(0, duration_ms - 10000, 5000), duration_ms - 10000) END) AS ws FROM clips),
f AS (SELECT session_id, file_index, ws, unnest(range(0, (least(ws + 10000, duration_ms) - ws) // 100)) AS i FROM w),
a AS (SELECT *, (i + file_index) % 7 < 4 AS s0, (i * 3) % 11 < 4 AS s1 FROM f),
act AS (SELECT session_id, file_index, ws, 100 * count(*) FILTER (CASE WHEN file_index % 2 = 0 THEN s0 ELSE s1 END) AS ms
  FROM a GROUP BY session_id, file_index, ws),
tg AS (SELECT DISTINCT a.session_id, a.file_index, a.ws + i * 100 AS start_ms, a.ws + i * 100 + 100 AS end_ms
  FROM a JOIN act USING (session_id, file_index, ws)
  WHERE act.ms >= 250 AND CASE WHEN file_index % 2 = 0 THEN s0 ELSE s1 END),
ov AS (SELECT DISTINCT session_id, file_index, ws + i * 100 AS start_ms, ws + i * 100 + 100 AS end_ms FROM a WHERE s0 AND s1),
{merged("tm", "tg", "session_id, file_index")}, {merged("om", "ov", "session_id, file_index")},
ts AS (SELECT session_id, file_index, sum(end_ms - start_ms) AS ms FROM tm GROUP BY session_id, file_index),
os AS (SELECT session_id, file_index, sum(end_ms - start_ms) AS ms FROM om GROUP BY session_id, file_index),
nw AS (SELECT session_id, file_index, count(*) AS n FROM w GROUP BY session_id, file_index)
SELECT c.session_id, c.file_index, coalesce(nw.n, 0) AS n_windows, {big("coalesce(ts.ms, 0)", "target_ms")},
  {big("coalesce(os.ms, 0)", "overlap_ms")}
FROM clips c LEFT JOIN nw USING (session_id, file_index) LEFT JOIN ts USING (session_id, file_index)
LEFT JOIN os USING (session_id, file_index)"""

SQL["contaminate_sessions"] = f"""WITH {FX}, {of("t0", "click")}, {of("o0", *OTHERS)}, {merged("t", "t0")},
j AS (SELECT t.*, EXISTS (SELECT 1 FROM o0 o WHERE o.session_id = t.session_id AND o.end_ms > o.start_ms
  AND t.start_ms < o.end_ms AND o.start_ms < t.end_ms) AS bad, end_ms - start_ms - 100 AS inner_ms FROM t),
d AS (SELECT *, CASE WHEN bad THEN 'NaN' WHEN inner_ms >= 500 THEN 'CLEAN' ELSE 'DISCARD' END AS decision FROM j),
e AS (SELECT *, CASE WHEN decision = 'CLEAN' THEN 50 ELSE 0 END AS k FROM d)
SELECT session_id, decision, start_ms AS segment_start_ms, start_ms + k AS start_local_ms, end_ms - k AS end_local_ms,
  start_ms + k + session_id * 1000 AS start_global_ms, end_ms - k + session_id * 1000 AS end_global_ms,
  end_ms - start_ms - 2 * k AS duration_ms,
  CASE WHEN decision = 'DISCARD' THEN greatest(0, inner_ms) END AS trimmed_ms FROM e"""

SQL["enroll_sessions"] = """WITH b AS (SELECT l_suppkey AS session_id, l_orderkey % 2000 * 250 + 125 AS pts_ms,
  l_orderkey * 10 + l_linenumber AS box_idx, l_partkey % 400 AS x1, l_partkey % 100 AS y1,
  trunc(l_partkey % 400 + l_quantity * 8) AS x2, trunc(l_partkey % 100 + l_quantity * 6) AS y2,
  [l_quantity, l_discount * 100, l_tax * 100] AS e FROM lineitem),
c AS (SELECT session_id, min(pts_ms) AS pts_ms FROM b GROUP BY session_id),
h AS (SELECT c.session_id, b.e AS t, row_number() OVER (PARTITION BY c.session_id
    ORDER BY (x2 - x1) * (y2 - y1), box_idx) AS rn
  FROM c JOIN b ON b.session_id = c.session_id AND b.pts_ms = c.pts_ms AND 250 BETWEEN x1 AND x2 AND 90 BETWEEN y1 AND y2),
r AS (SELECT session_id, t FROM h WHERE rn = 1),
s AS (SELECT b.session_id, pts_ms, list_dot_product(e, t) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(t, t))) >= 0.9 AS hit
  FROM b JOIN r USING (session_id)),
frames AS (SELECT session_id, pts_ms, count(*) = 1 AND bool_or(hit) AS clean FROM s GROUP BY session_id, pts_ms),
speech AS (SELECT DISTINCT l_suppkey AS session_id, l_partkey % 1990 * 250 AS start_ms,
  l_partkey % 1990 * 250 + (l_linenumber % 3 + 1) * 250 AS end_ms FROM lineitem),
pts AS (SELECT *, unnest(range(start_ms + 125, end_ms, 250)) AS pts_ms FROM speech),
cw AS (SELECT p.session_id, p.start_ms, p.end_ms FROM pts p
  LEFT JOIN frames f ON f.session_id = p.session_id AND f.pts_ms = p.pts_ms
  GROUP BY p.session_id, p.start_ms, p.end_ms HAVING bool_and(coalesce(f.clean, false))),
g AS (SELECT r.session_id, count(cw.start_ms) AS n_windows, CAST(coalesce(sum(end_ms - start_ms), 0) AS BIGINT) AS total_ms
  FROM r LEFT JOIN cw ON cw.session_id = r.session_id GROUP BY r.session_id)
SELECT *, CASE WHEN n_windows = 0 THEN 'no clean single-target enrollment windows found'
  WHEN total_ms < 30000 THEN 'clean enrollment audio below seed_min_ms' END AS reason,
  CASE WHEN n_windows > 0 AND total_ms >= 30000 THEN n_windows END AS n_vectors FROM g
UNION ALL
SELECT session_id, 0, 0, 'speaking_click did not land on any detected face', NULL FROM c
WHERE session_id NOT IN (SELECT session_id FROM r)"""

SQL["compare_sessions"] = f"""WITH {_NESTED}, {FX},
sg AS (SELECT session_id, ms AS start_ms, TRY_CAST(en AS BIGINT) AS end_ms FROM nested
  WHERE operation = 'layer3_segment' AND (seq % 3 = 0 OR inner_op = operation)),
t0 AS (SELECT * FROM sg WHERE end_ms > start_ms), {merged("t", "t0")},
{merged("s", "fx", "session_id, speaker_id")},
ov AS (SELECT s.session_id, s.speaker_id,
  coalesce(sum(least(s.end_ms, t.end_ms) - greatest(s.start_ms, t.start_ms)) FILTER (t.session_id IS NOT NULL), 0) AS ms
  FROM s LEFT JOIN t ON s.session_id = t.session_id AND s.start_ms < t.end_ms AND t.start_ms < s.end_ms
  GROUP BY s.session_id, s.speaker_id),
best AS (SELECT session_id, speaker_id, {big("ms", "overlap_ms")} FROM ov
  QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY ms DESC, speaker_id) = 1),
ta AS (SELECT session_id, sum(end_ms - start_ms) AS a FROM t GROUP BY session_id),
sb AS (SELECT s.session_id, sum(end_ms - start_ms) AS b FROM s JOIN best USING (session_id, speaker_id) GROUP BY s.session_id)
SELECT best.session_id, speaker_id, overlap_ms, {big("coalesce(a, 0)", "a_ms")}, {big("b", "b_ms")},
  overlap_ms AS intersection_ms, {big("coalesce(a, 0) + b - overlap_ms", "union_ms")}
FROM best JOIN sb USING (session_id) LEFT JOIN ta USING (session_id)"""

_COMPARED = SQL["compare_sessions"].partition("ta AS (")[0]

SQL["compare_segments"] = f"""{_COMPARED}
n AS (SELECT *, row_number() OVER () AS id FROM t0),
m AS (SELECT s.* FROM s JOIN best USING (session_id, speaker_id)),
c AS (SELECT n.id, sum(least(n.end_ms, m.end_ms) - greatest(n.start_ms, m.start_ms)) AS ms
  FROM n JOIN m ON n.session_id = m.session_id AND n.start_ms < m.end_ms AND m.start_ms < n.end_ms GROUP BY n.id),
p AS (SELECT n.*, {big("coalesce(ms, 0)", "covered_ms")} FROM n LEFT JOIN c USING (id))
SELECT session_id, start_ms, end_ms, covered_ms, CASE WHEN 100.0::DOUBLE * covered_ms / (end_ms - start_ms) >= 80 THEN 'AGREE'
  WHEN 100.0::DOUBLE * covered_ms / (end_ms - start_ms) >= 20 THEN 'PARTIAL' ELSE 'MISS' END AS verdict FROM p"""

SQL["compare_inventory"] = f"""{_COMPARED}
inv AS (SELECT session_id, speaker_id, {big("sum(end_ms - start_ms)", "speech_ms")}, count(*) AS n_turns
  FROM s GROUP BY session_id, speaker_id)
SELECT inv.session_id, inv.speaker_id, speech_ms, n_turns, inv.speaker_id = best.speaker_id AS matched
FROM inv JOIN best USING (session_id)"""

_GRID = "grid AS" + _LANES.partition("grid AS")[2].replace("40", "20")

_COLUMNS = f"""{_COMPARED}
l AS (SELECT session_id, 'target' AS lane, start_ms, end_ms FROM t0
  UNION ALL SELECT session_id, 'speaker:' || speaker_id, start_ms, end_ms FROM fx
  UNION ALL SELECT fx.session_id, 'matched', fx.start_ms, fx.end_ms FROM fx JOIN best USING (session_id, speaker_id)),
b AS (SELECT session_id, min(start_ms) AS t0, max(end_ms) - min(start_ms) AS span FROM l GROUP BY session_id),
{_GRID}"""

SQL["compare_lanes"] = f"{_COLUMNS} SELECT session_id, lane, CAST(col AS INTEGER) AS col FROM lanes WHERE active"

SQL["compare_diff"] = f"""{_COLUMNS},
w AS (SELECT session_id, col, coalesce(bool_or(active) FILTER (lane = 'target'), false) AS a,
  coalesce(bool_or(active) FILTER (lane = 'matched'), false) AS b FROM lanes GROUP BY session_id, col)
SELECT session_id, CAST(col AS INTEGER) AS col, CASE WHEN a AND b THEN 'both' WHEN a THEN 'a' WHEN b THEN 'b' ELSE 'neither' END AS verdict
FROM w"""

SQL["sanitize_lines"] = """WITH t AS (SELECT user_id, arg_min(event_type, event_id) AS token FROM events
  WHERE user_id % 10 <> 3 GROUP BY user_id),
l AS (SELECT user_id AS session_id, event_id AS position, token, '{"note":"' || upper(event_type) || '","operation":"'
  || event_type || '","schema":"' || event_type || '-manifest-v1"}' AS line FROM events JOIN t USING (user_id))
SELECT session_id, position, regexp_replace(line, token, 'anon', 'gi') AS line,
  CAST((length(line) - length(regexp_replace(line, token, '', 'gi'))) // length(token) AS BIGINT) AS n_redacted FROM l"""

SQL["audit_log_round_trip"] = (
    SQL["chain_build"]
    .replace("SELECT session_id, seq, operation, repeat", "SELECT session_id, seq, operation, payload, repeat")
    .replace("SELECT h.session_id, h.seq, h.operation, c.", "SELECT h.session_id, h.seq, h.operation, h.payload, c.")
    .replace(
        "SELECT * FROM chain",
        "SELECT session_id::VARCHAR AS session_id, seq AS position, seq, operation, payload, entry_sha256 FROM chain",
    )
)

SQL["chain_breaks"] = f"""WITH {_LOG}
SELECT session_id, CASE WHEN session_id % 5 = 2 THEN seq - 1 ELSE seq END AS "index", seq,
  CASE session_id % 5 WHEN 0 THEN 'payload hash mismatch' WHEN 2 THEN CASE WHEN seq = 8 THEN 'prev_sha256 mismatch'
    ELSE 'seq out of order' END ELSE 'entry hash mismatch' END AS reason
FROM recs WHERE (session_id % 5 IN (0, 1, 3) AND seq = 7) OR (session_id % 5 = 2 AND seq > 7)"""

SQL["audit_stream"] = SQL["chain_breaks"]
SQL["audit_stream_late"] = SQL["chain_breaks"]
SQL["audit_log_append"] = SQL["audit_log_round_trip"]


SQL["gate_sessions"] = """WITH files AS (SELECT doc_id, lang || '/' || doc_id || '.txt' AS path, sha256(text) AS sha FROM documents),
m AS (SELECT s_suppkey AS session_id, unnest(['eend_m2f', 'insightface', 'wavlm', 'yolov8']) AS name,
  unnest(range(0, 4)) AS i FROM supplier),
r AS (SELECT session_id, name, files.path AS p, sha,
    CASE WHEN session_id % 7 = 1 AND i = 3 THEN 'lost.bin' ELSE files.path END AS path,
    CASE WHEN session_id % 7 = 3 AND i = 3 THEN reverse(sha) ELSE sha END AS expected
  FROM m JOIN files ON doc_id = session_id % 50 + i WHERE NOT (session_id % 7 = 5 AND i = 3)),
c AS (SELECT session_id, name, path, sha, CASE WHEN path <> p THEN 'MISSING' WHEN expected <> sha THEN 'MISMATCH' ELSE 'OK' END AS status FROM r
  UNION ALL SELECT session_id, name, NULL, NULL, 'REQUIRED' FROM m WHERE session_id % 7 = 5 AND i = 3)
SELECT session_id, count(*) FILTER (status = 'OK') AS n_models, count(*) FILTER (status <> 'OK') AS n_problems,
  count(*) FILTER (status <> 'OK') = 0 AS passed,
  CASE WHEN count(*) FILTER (status <> 'OK') = 0 THEN
    '[' || string_agg('{"name":"' || name || '","sha256":"' || sha || '"}', ',' ORDER BY name) || ']' END AS models,
  coalesce(string_agg(concat_ws(' ', status, name, path), ',' ORDER BY status, name, path) FILTER (status <> 'OK'), '') AS problems
FROM c GROUP BY session_id"""
