"""The longer SQL of problems 2 to 5: what the operators find, said again in plain SQL."""

REJECTS = r"""
WITH r AS (
  SELECT line_id, t.topic, value_format AS vf, coalesce(delimiter, ',') AS d, record_value AS v,
         CASE delimiter WHEN '|' THEN '\|' ELSE coalesce(delimiter, ',') END AS e
  FROM raw_records x JOIN sink_topics t ON x.topic = t.topic WHERE value_format IN ('csv', 'json')),
f AS (SELECT topic, count(*) AS n FROM topic_fields GROUP BY topic),
typed AS (
  SELECT * FROM (SELECT topic, field_pos, field_path, field_type AS ty, is_optional AS opt FROM topic_fields) z),
csv AS (
  SELECT r.*, f.n, regexp_full_match(v, '("(""|[^"])*"|[^"' || e || '\r\n]*)(' || e || '("(""|[^"])*"|[^"' || e || '\r\n]*))*') AS quoted,
         regexp_extract_all(d || v, e || '("(?:""|[^"])*"|[^"' || e || '\r\n]*)', 1) AS parts
  FROM r JOIN f USING (topic) WHERE vf = 'csv'),
csv_cells AS (
  SELECT c.line_id, y.ty, y.opt,
         CASE WHEN p LIKE '"%' THEN replace(p[2:-2], '""', '"') ELSE p END AS raw
  FROM (SELECT line_id, topic, unnest(parts) AS p, generate_subscripts(parts, 1) - 1 AS pos FROM csv WHERE quoted AND v <> '' AND len(parts) = n) c
  JOIN typed y ON y.topic = c.topic AND y.field_pos = c.pos),
json AS (
  SELECT *, ok AND coalesce(json_type(CASE WHEN ok THEN v END), '') = 'OBJECT' AS quoted,
         CASE WHEN ok AND json_type(CASE WHEN ok THEN v END) = 'OBJECT' THEN json_keys(v) END AS ks
  FROM (SELECT *, json_valid(v) AND NOT regexp_matches(regexp_replace(v, '"(\\.|[^"\\])*"', '""', 'g'), ',\s*[}\]]|(?i:nan|inf)') AS ok FROM r WHERE vf = 'json')),
json_cols AS (
  SELECT j.line_id, bool_or(NOT y.opt AND NOT list_contains(ks, y.field_path)) OR len(list_filter(any_value(ks), lambda k: NOT list_contains(any_known, k))) > 0 AS bad
  FROM json j JOIN typed y ON y.topic = j.topic JOIN (SELECT topic, list(field_path) AS any_known FROM topic_fields GROUP BY topic) a ON a.topic = j.topic
  WHERE quoted GROUP BY j.line_id, any_known),
json_cells AS (
  SELECT j.line_id, y.ty, y.opt, json_type(v, '$."' || y.field_path || '"') AS jt, json_extract_string(v, '$."' || y.field_path || '"') AS raw
  FROM json j JOIN typed y ON y.topic = j.topic JOIN json_cols c ON c.line_id = j.line_id WHERE quoted AND NOT bad),
cells AS (
  SELECT line_id, ty, opt, raw, CASE WHEN ty = 'string' THEN raw ELSE trim(raw, E' \t') END AS t, true AS kind_ok FROM csv_cells
  UNION ALL
  SELECT line_id, ty, opt, raw, raw, CASE WHEN ty LIKE 'int%' THEN jt IN ('BIGINT', 'UBIGINT', 'HUGEINT') AND raw NOT LIKE '%.%' AND raw NOT ILIKE '%e%' WHEN ty LIKE 'float%' THEN jt IN ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE') WHEN ty = 'boolean' THEN jt = 'BOOLEAN' ELSE jt = 'VARCHAR' END
  FROM json_cells WHERE jt IS NOT NULL AND jt <> 'NULL' OR NOT opt),
bad_cells AS (
  SELECT DISTINCT line_id FROM cells WHERE CASE
    WHEN raw IS NULL OR t = '' THEN NOT opt
    WHEN NOT coalesce(kind_ok, false) THEN true
    WHEN ty = 'int32' THEN NOT regexp_full_match(t, '[+-]?[0-9]+') OR try_cast(t AS HUGEINT) IS NULL OR try_cast(t AS HUGEINT) NOT BETWEEN -2147483648 AND 2147483647
    WHEN ty = 'int64' THEN NOT regexp_full_match(t, '[+-]?[0-9]+') OR try_cast(t AS HUGEINT) IS NULL OR try_cast(t AS HUGEINT) NOT BETWEEN -9223372036854775808 AND 9223372036854775807
    WHEN ty LIKE 'float%' THEN NOT regexp_full_match(t, '[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?') OR NOT coalesce(isfinite(try_cast(t AS DOUBLE)), false)
    WHEN ty = 'boolean' THEN lower(t) NOT IN ('true', 'false')
    WHEN ty = 'date' THEN NOT regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}') OR try_cast(t AS DATE) IS NULL
    WHEN ty = 'timestamp' THEN NOT regexp_full_match(trim(t), '[0-9]{4}-[0-9]{2}-[0-9]{2}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]{1,9})?(Z|[+-](0[0-9]|1[0-7]):?[0-5][0-9]|[+-]18:?00)?') OR try_cast(trim(t)[1:10] AS DATE) IS NULL
    ELSE false END)
SELECT line_id, CASE WHEN NOT quoted THEN 'quoting' WHEN v = '' OR len(parts) <> n THEN 'columns' ELSE 'value' END AS reason
FROM csv WHERE NOT quoted OR v = '' OR len(parts) <> n OR line_id IN (SELECT line_id FROM bad_cells)
UNION ALL
SELECT line_id, CASE WHEN NOT quoted THEN 'quoting' WHEN bad THEN 'columns' ELSE 'value' END
FROM json LEFT JOIN json_cols USING (line_id) WHERE NOT quoted OR bad OR line_id IN (SELECT line_id FROM bad_cells)"""

_CTES, _, _FAILED = REJECTS.rpartition("SELECT line_id, CASE WHEN NOT quoted THEN 'quoting' WHEN v = ''")
TYPED = (
    _CTES.rstrip()
    + r""",
failed AS (SELECT line_id, CASE WHEN NOT quoted THEN 'quoting' WHEN v = ''"""
    + _FAILED
    + r"""),
shown AS (
  SELECT c.topic, y.field_path, y.ty, CASE WHEN p LIKE '"%' THEN replace(p[2:-2], '""', '"') ELSE p END AS raw, true AS delimited
  FROM (SELECT topic, unnest(parts) AS p, generate_subscripts(parts, 1) - 1 AS pos FROM csv WHERE line_id NOT IN (SELECT line_id FROM failed)) c
  JOIN topic_fields z ON z.topic = c.topic AND z.field_pos = c.pos JOIN (SELECT topic, field_path, field_type AS ty FROM topic_fields) y ON y.topic = c.topic AND y.field_path = z.field_path
  UNION ALL
  SELECT j.topic, y.field_path, y.field_type, json_extract_string(v, '$."' || y.field_path || '"'), false
  FROM json j JOIN topic_fields y ON y.topic = j.topic WHERE line_id NOT IN (SELECT line_id FROM failed)),
clean AS (SELECT topic, field_path, ty, CASE WHEN ty = 'string' THEN CASE WHEN delimited THEN nullif(raw, '') ELSE raw END ELSE nullif(trim(raw, E' \t'), '') END AS t FROM shown)
SELECT topic, field_path, count(t) AS n_values,
  CASE WHEN ty LIKE 'int%' THEN CAST(min(CASE WHEN ty LIKE 'int%' THEN CAST(t AS BIGINT) END) AS VARCHAR) WHEN ty = 'timestamp' THEN CAST(min(CASE WHEN ty = 'timestamp' THEN epoch_us(CAST(CASE WHEN regexp_matches(t, '(Z|[+-][0-9]{2}:?[0-9]{2})$') THEN t ELSE t || 'Z' END AS TIMESTAMPTZ)) END) AS VARCHAR)
    WHEN ty LIKE 'float%' THEN NULL WHEN ty = 'boolean' THEN min(lower(t)) ELSE min(t) END AS low,
  CASE WHEN ty LIKE 'int%' THEN CAST(max(CASE WHEN ty LIKE 'int%' THEN CAST(t AS BIGINT) END) AS VARCHAR) WHEN ty = 'timestamp' THEN CAST(max(CASE WHEN ty = 'timestamp' THEN epoch_us(CAST(CASE WHEN regexp_matches(t, '(Z|[+-][0-9]{2}:?[0-9]{2})$') THEN t ELSE t || 'Z' END AS TIMESTAMPTZ)) END) AS VARCHAR)
    WHEN ty LIKE 'float%' THEN NULL WHEN ty = 'boolean' THEN max(lower(t)) ELSE max(t) END AS high
FROM clean GROUP BY topic, field_path, ty"""
)

SMALL = r"""
WITH live AS (
  SELECT file_id, topic, flushed_at,
         len(regexp_extract_all(coalesce(file_content, ''), '[^ \t\x0B\f\r\n][^\r\n]*')) AS n,
         coalesce(octet_length(encode(file_content)), 0) AS b
  FROM data_files WHERE end_snapshot IS NULL),
s AS (
  SELECT l.file_id, x.setting_name, arg_max(x.setting_id, (x.valid_from, x.setting_id)) AS setting_id
  FROM live l JOIN sink_settings x ON x.topic = l.topic AND x.valid_from <= l.flushed_at
  WHERE x.setting_name IN ('flush.size', 'file.size.bytes') GROUP BY ALL),
v AS (
  SELECT s.file_id, s.setting_name, try_cast(trim(x.setting_value, E' \t\r\n') AS BIGINT) AS v
  FROM s JOIN sink_settings x USING (setting_id))
SELECT l.file_id FROM live l
LEFT JOIN v f ON f.file_id = l.file_id AND f.setting_name = 'flush.size'
LEFT JOIN v z ON z.file_id = l.file_id AND z.setting_name = 'file.size.bytes'
WHERE l.n < coalesce(f.v, 1000000) AND l.b < coalesce(z.v, 268435456)"""

MERGED = (
    "WITH small AS ("
    + SMALL
    + r"""),
f AS (
  SELECT *, list_filter(string_split_regex(coalesce(file_content, ''), '\r\n|\n|\r'), lambda x: regexp_matches(x, '[^ \t\x0B\f\r\n]')) AS recs FROM data_files),
alive AS (SELECT * FROM f WHERE end_snapshot IS NULL),
firsts AS (SELECT topic, kafka_partition, first_offset, last_offset, recs, min(file_id) AS first_file FROM alive GROUP BY ALL),
gone AS (SELECT topic, kafka_partition, first_offset, last_offset, recs, min(end_snapshot) AS merged_at FROM f WHERE end_snapshot IS NOT NULL GROUP BY ALL),
twins AS (
  SELECT a.file_id, a.topic, a.kafka_partition, a.first_offset, a.last_offset, a.recs, g.merged_at FROM alive a JOIN gone g
  ON a.topic IS NOT DISTINCT FROM g.topic AND a.kafka_partition IS NOT DISTINCT FROM g.kafka_partition AND a.first_offset = g.first_offset AND a.last_offset = g.last_offset AND a.recs = g.recs
  WHERE len(a.recs) > 0),
pairs AS (
  SELECT t.file_id, h.file_id AS held_by, t.recs, h.recs AS held FROM twins t JOIN alive h
  ON h.topic IS NOT DISTINCT FROM t.topic AND h.kafka_partition IS NOT DISTINCT FROM t.kafka_partition AND h.first_offset <= t.first_offset AND h.last_offset >= t.last_offset AND h.file_id <> t.file_id
  WHERE (h.begin_snapshot IS NULL OR h.begin_snapshot >= t.merged_at)
    AND (h.first_offset < t.first_offset OR h.last_offset > t.last_offset OR len(h.recs) > len(t.recs) OR h.file_id NOT IN (SELECT file_id FROM twins) OR h.file_id < t.file_id)),
mine AS (SELECT file_id, held_by, r, count(*) AS n FROM (SELECT file_id, held_by, unnest(recs) AS r FROM pairs) GROUP BY ALL),
theirs AS (SELECT file_id, held_by, r, count(*) AS n FROM (SELECT file_id, held_by, unnest(held) AS r FROM pairs) GROUP BY ALL),
held AS (
  SELECT file_id, min(held_by) AS held_by FROM (
    SELECT m.file_id, m.held_by FROM mine m LEFT JOIN theirs t ON t.file_id = m.file_id AND t.held_by = m.held_by AND t.r = m.r
    GROUP BY m.file_id, m.held_by HAVING bool_and(coalesce(t.n, 0) >= m.n)) GROUP BY file_id)
SELECT a.topic, a.kafka_partition, count(*) AS n_files, CAST(sum(len(a.recs)) AS BIGINT) AS n_records, CAST(sum(coalesce(list_sum(list_transform(a.recs, lambda x: strlen(x) + 1)), 0)) AS BIGINT) AS n_bytes
FROM alive a JOIN firsts s ON a.topic IS NOT DISTINCT FROM s.topic AND a.kafka_partition IS NOT DISTINCT FROM s.kafka_partition AND a.first_offset IS NOT DISTINCT FROM s.first_offset AND a.last_offset IS NOT DISTINCT FROM s.last_offset AND a.recs = s.recs
WHERE a.file_id IN (SELECT file_id FROM small) AND a.file_id = s.first_file AND a.file_id NOT IN (SELECT file_id FROM held) GROUP BY ALL"""
)

TIMES = r"""
WITH texts AS (
  SELECT row_id, topic, 'created_at' AS field_name, created_at AS raw FROM intake_rows WHERE created_at IS NOT NULL
  UNION ALL SELECT row_id, topic, 'record_timestamp', record_timestamp FROM intake_rows WHERE record_timestamp IS NOT NULL),
x AS (
  SELECT row_id, field_name, trim(raw, E' \t\r\n') AS s, zone_name, day_order FROM texts LEFT JOIN sink_topics USING (topic)
  WHERE NOT (regexp_full_match(raw, '[0-9]{4}-[0-9]{2}-[0-9]{2}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\.[0-9]{6}Z') AND try_cast(raw[1:10] AS DATE) IS NOT NULL)),
clock AS (
  SELECT *, CASE
      WHEN regexp_full_match(s, '[0-9]{10}(\.[0-9]+)?|[0-9]{13}|[0-9]{16}|[0-9]{19}') THEN 'count'
      WHEN regexp_matches(s, '^[0-9]{4}([-/])[0-9]{1,2}[-/][0-9]{1,2}[Tt ]') THEN 'ymd'
      WHEN regexp_matches(s, '^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4} ') THEN 'dotted'
      WHEN regexp_matches(s, '^[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{4} ') THEN 'numeric'
      WHEN regexp_matches(s, '^([A-Za-z]{3}, )?[0-9]{1,2}[- ][A-Za-z]{3,9}[- ][0-9]{4} ') THEN 'dmon'
      WHEN regexp_matches(s, '^[A-Za-z]{3} [0-9]{1,2}, [0-9]{4} ') THEN 'mond'
      WHEN regexp_full_match(s, '[0-9]{8}T?[0-9]{6}Z?') THEN 'compact' END AS kind
  FROM x),
parts AS (
  SELECT *, CASE WHEN kind = 'compact' THEN regexp_extract(s, '([0-9]{2})([0-9]{2})([0-9]{2})Z?$', ['h', 'mi', 'sec']) ELSE regexp_extract(s, '[Tt ]([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}))?', ['h', 'mi', 'sec']) END AS hms,
    regexp_extract(s, ':[0-9]{2}[.,]([0-9]+)', 1) AS frac,
    lower(regexp_extract(s, '[0-9] ?([AaPp][Mm])$', 1)) AS ap,
    regexp_extract(s, '(?:[0-9] ?|[AaPp][Mm] ?)(Z|z|UTC|GMT|[+-][0-9]{2}(?::?[0-9]{2})?)(?:\[.*\])?$', 1) AS z,
    regexp_extract(s, '([A-Z][A-Za-z]+/[A-Za-z_]+)\]?$', 1) AS named,
    regexp_extract_all(s, '[0-9]+') AS nums, lower(regexp_extract(regexp_replace(s, '^[A-Za-z]{3}, ', ''), '[A-Za-z]{3}')) AS mon
  FROM clock WHERE kind IS NOT NULL AND kind <> 'count'),
dates AS (
  SELECT *, CASE kind
      WHEN 'ymd' THEN nums[1] || '-' || lpad(nums[2], 2, '0') || '-' || lpad(nums[3], 2, '0')
      WHEN 'dotted' THEN nums[3] || '-' || lpad(nums[2], 2, '0') || '-' || lpad(nums[1], 2, '0')
      WHEN 'numeric' THEN nums[3] || '-' || CASE WHEN day_order = 'mdy' THEN lpad(nums[1], 2, '0') || '-' || lpad(nums[2], 2, '0') ELSE lpad(nums[2], 2, '0') || '-' || lpad(nums[1], 2, '0') END
      WHEN 'dmon' THEN nums[2] || '-' || lpad(CAST(list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], mon) AS VARCHAR), 2, '0') || '-' || lpad(nums[1], 2, '0')
      WHEN 'mond' THEN nums[2] || '-' || lpad(CAST(list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], mon) AS VARCHAR), 2, '0') || '-' || lpad(nums[1], 2, '0')
      WHEN 'compact' THEN s[1:4] || '-' || s[5:6] || '-' || s[7:8] END AS day
  FROM parts),
locals AS (
  SELECT *, try_cast(day AS DATE) AS d, CAST(hms.mi AS INTEGER) AS mi, CAST(CASE WHEN hms.sec = '' THEN '0' ELSE hms.sec END AS INTEGER) AS sec,
    CASE WHEN ap = '' THEN CAST(hms.h AS INTEGER) WHEN CAST(hms.h AS INTEGER) BETWEEN 1 AND 12 THEN CAST(hms.h AS INTEGER) % 12 + CASE ap WHEN 'pm' THEN 12 ELSE 0 END ELSE 99 END AS h
  FROM dates WHERE try_cast(day AS DATE) IS NOT NULL AND hms.h <> ''),
instants AS (
  SELECT row_id, field_name, z, coalesce(nullif(named, ''), zone_name) AS zn, make_timestamp(epoch_us(CAST(d AS TIMESTAMP)) + CAST((h * 60 + mi) * 60 + sec AS BIGINT) * 1000000) AS wall,
    CAST(rpad(frac, 6, '0')[1:6] AS BIGINT) AS us
  FROM locals WHERE h < 24 AND mi < 60 AND sec < 60),
zoned AS (
  SELECT row_id, field_name, us, wall, zn, CASE WHEN z <> '' THEN CASE WHEN upper(z) IN ('Z', 'UTC', 'GMT') THEN 0 ELSE (CASE z[1] WHEN '-' THEN -1 ELSE 1 END) * (CAST(replace(z, ':', '')[2:3] AS INTEGER) * 60 + CAST('0' || replace(z, ':', '')[4:5] AS INTEGER)) END END AS off,
    CASE WHEN z = '' AND zn IS NOT NULL THEN timezone(zn, wall) END AS inst
  FROM instants)
SELECT row_id, field_name, CAST(us + CASE WHEN off IS NOT NULL THEN epoch_us(wall) - CAST(off AS BIGINT) * 60000000 WHEN zn IS NULL THEN epoch_us(wall)
    WHEN timezone(zn, inst - INTERVAL 1 HOUR) = wall THEN epoch_us(inst) - 3600000000 ELSE epoch_us(inst) END AS BIGINT) AS utc_us
FROM zoned
UNION ALL
SELECT row_id, field_name, CASE WHEN length(s) = 13 THEN CAST(s AS BIGINT) * 1000 WHEN length(s) = 16 AND NOT contains(s, '.') THEN CAST(s AS BIGINT) WHEN length(s) = 19 AND NOT contains(s, '.') THEN CAST(s AS BIGINT) // 1000
    ELSE CAST(s[1:10] AS BIGINT) * 1000000 + CAST(rpad(s[12:17], 6, '0') AS BIGINT) END
FROM clock WHERE kind = 'count'"""

COPIES = r"""
WITH RECURSIVE ids AS (SELECT topic, string_split(replace(table_id_columns, ' ', ''), ',') AS c FROM sink_topics WHERE table_id_columns IS NOT NULL),
flat AS (
  SELECT s.delivery_id, any_value(s.topic) AS topic, string_agg(t.fullkey || '=' || t.type || ':' || coalesce(CAST(t.atom AS VARCHAR), ''), '|' ORDER BY t.fullkey) AS content
  FROM sink_records s, json_tree(s.record_value) t WHERE s.record_value IS NOT NULL GROUP BY s.delivery_id),
whole AS (
  SELECT f.delivery_id FROM flat f JOIN ids i ON f.topic = i.topic JOIN sink_records s ON s.delivery_id = f.delivery_id
  WHERE len(list_filter(i.c, lambda x: json_extract_string(s.record_value, '$."' || x || '"') IS NULL)) = 0),
keys AS (
  SELECT delivery_id, concat_ws(chr(1), 'p', topic, kafka_partition, kafka_offset) AS k FROM sink_records
  WHERE topic IS NOT NULL AND kafka_partition IS NOT NULL AND kafka_offset IS NOT NULL
  UNION ALL SELECT delivery_id, concat_ws(chr(1), 'c', topic, content) FROM flat JOIN whole USING (delivery_id)),
shared AS (SELECT * FROM keys WHERE k IN (SELECT k FROM keys GROUP BY k HAVING count(*) > 1)),
near AS (SELECT DISTINCT a.delivery_id AS a, b.delivery_id AS b FROM shared a JOIN shared b ON a.k = b.k),
reach AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a),
copies AS (SELECT min(b) AS first_id, a AS copy_id FROM reach GROUP BY a HAVING min(b) <> a)"""
