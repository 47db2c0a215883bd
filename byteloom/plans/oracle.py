"""The queries once more as SQL over the driver's tables."""

from __future__ import annotations

import re

from byteloom.plans import fixtures as fx

_VIEWS = {
    "telemetry": fx.SQL_TELEMETRY,
    "vehicles": fx.SQL_VEHICLES,
    "joined": fx.SQL_JOINED,
    "lengths": fx.SQL_LENGTHS,
    "out_columns": fx.SQL_COLUMNS,
    "layouts": fx.SQL_FIELDS,
    "linear": fx.SQL_LINEAR,
    "enums": fx.SQL_ENUM,
    "messages": """
SELECT event_id, model_name, family, model_year, 'A' AS message, msg_a AS hex FROM joined
UNION ALL SELECT event_id, model_name, family, model_year, 'B', msg_b FROM joined
""",
    "fields": """
SELECT l.*, CAST(regexp_extract(byte, '^(\\d+)', 1) AS BIGINT) AS bp,
  CAST(regexp_extract(byte, '\\[(\\d+)\\]', 1) AS BIGINT) AS bb,
  CAST(regexp_extract(size, '^(\\d+)', 1) AS BIGINT) AS n,
  CAST(regexp_extract(size, '\\[(\\d+)\\]', 1) AS BIGINT) AS k,
  row_number() OVER (PARTITION BY family, model_year, message, description ORDER BY ord DESC) AS back
FROM layouts l
""",
    "linear_first": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY family, model_year, id ORDER BY row_ord) AS rn
  FROM linear) WHERE rn = 1
""",
    "linear_labels": """
SELECT family, model_year, id, row_ord, encoding_name, trim(raw_min) AS lo_text, trim(raw_max) AS hi_text,
  TRY_CAST('0x' || replace(trim(raw_min), '$', '') AS BIGINT) AS lo,
  TRY_CAST('0x' || replace(trim(raw_max), '$', '') AS BIGINT) AS hi
FROM linear WHERE encoding_name IS NOT NULL
""",
    "placed": """
SELECT m.event_id, m.model_name, m.hex, length(m.hex) AS len, f.*,
  substr(m.hex, 2 * bp + 1, 2) AS b0, substr(m.hex, 2 * bp + 1, 2 * n) AS whole,
  CASE WHEN bp > 0 THEN substr(m.hex, 2 * bp - 1, 2) ELSE '' END AS before,
  CASE WHEN bb > 0 AND (bp + greatest(n, 1) + 1) * 2 <= length(m.hex)
    THEN substr(m.hex, 2 * (bp + greatest(n, 1)) + 1, 2) END AS after_run
FROM messages m JOIN fields f
  ON m.family = f.family AND m.model_year = f.model_year AND m.message = f.message
WHERE m.hex IS NOT NULL
""",
    "checked": """
SELECT *, CASE
  WHEN n = 0 AND k > 0 THEN CASE
    WHEN bp * 2 + 2 > len THEN 'Byte ' || bp || ' not available in DDT string'
    WHEN bb > 7 THEN 'Invalid bit_start ' || bb || ', must be 0-7'
    WHEN bb + k > 8 THEN 'Invalid bit range: start=' || bb || ', count=' || k
    WHEN NOT regexp_full_match(b0, '[0-9A-Fa-f]+')
      THEN 'invalid literal for int() with base 16: ''' || b0 || '''' END
  WHEN n > 0 AND k = 0 THEN CASE
    WHEN bp * 2 + 2 > len THEN 'Byte ' || bp || ' not available in DDT string'
    WHEN bb > 7 THEN 'Invalid bit_pos ' || bb || ', must be 0-7'
    WHEN NOT regexp_full_match(whole, '[0-9A-Fa-f]+')
      THEN 'invalid literal for int() with base 16: ''' || whole || '''' END
  ELSE CASE
    WHEN bb > 7 THEN 'Invalid bit_offset ' || bb || ', must be 0-7'
    WHEN (bp + greatest(n, 1)) * 2 > len THEN 'Insufficient data: need bytes ' || bp || ' to '
      || (bp + greatest(n, 1) - 1) || ', but only ' || (len // 2)
      || ' bytes available in DDT string'
    WHEN list_filter(range(greatest(n, 1)), lambda i:
        NOT regexp_full_match(substr(hex, 2 * (bp + i) + 1, 2), '[0-9A-Fa-f]+'))[1] IS NOT NULL
      THEN 'invalid literal for int() with base 16: ''' || substr(hex, 2 * (bp + list_filter(
        range(greatest(n, 1)), lambda i:
        NOT regexp_full_match(substr(hex, 2 * (bp + i) + 1, 2), '[0-9A-Fa-f]+'))[1]) + 1, 2) || ''''
    WHEN after_run IS NOT NULL AND NOT regexp_full_match(after_run, '[0-9A-Fa-f]+')
      THEN 'invalid literal for int() with base 16: ''' || after_run || ''''
    WHEN k > 0 AND bp = 0 THEN 'Cannot expand backward beyond byte 0'
    WHEN k > 0 AND NOT regexp_full_match(before, '[0-9A-Fa-f]+')
      THEN 'invalid literal for int() with base 16: ''' || before || '''' END
  END AS error
FROM placed
""",
    "extracted": """
SELECT *, CASE WHEN error IS NOT NULL THEN NULL
  WHEN n = 0 AND k > 0 THEN (CAST('0x' || b0 AS BIGINT) >> bb) & ((1 << k) - 1)
  WHEN n > 0 AND k = 0 THEN CAST('0x' || whole AS BIGINT)
  ELSE CAST(((
      list_sum(list_transform(range(greatest(n, 1)), lambda i:
        CAST('0x' || substr(hex, 2 * (bp + i) + 1, 2) AS HUGEINT) * (CAST(1 AS HUGEINT) << (8 * i))))
      + coalesce(CAST('0x' || after_run AS HUGEINT), 0) * (CAST(1 AS HUGEINT) << (8 * greatest(n, 1))))
      >> CAST(bb AS HUGEINT)) & ((CAST(1 AS HUGEINT) << (8 * greatest(n, 1))) - 1) AS BIGINT)
    | CASE WHEN k > 0 THEN (CAST('0x' || before AS BIGINT) & ((1 << k) - 1)) << (8 * n) ELSE 0 END
  END AS raw
FROM checked
""",
    "stated": """
SELECT e.*, TRY_CAST(e.id AS BIGINT) AS id_number,
  CASE WHEN e.type = 'L' AND e.id IS NOT NULL AND tl.family IS NOT NULL THEN
      CASE WHEN TRY_CAST(e.id AS BIGINT) IS NULL THEN 'bad_id' WHEN lf.id IS NULL THEN 'raw' ELSE 'row' END
    WHEN e.type = 'T' AND e.id IS NOT NULL AND te.family IS NOT NULL THEN
      CASE WHEN TRY_CAST(e.id AS BIGINT) IS NULL THEN 'bad_id' ELSE 'row' END
    ELSE 'raw' END AS state,
  lf.factor, lf.offset_b, coalesce(lf.decimals, 0) AS decimals, lf.units AS unit_text,
  CASE WHEN trim(lf.raw_max) LIKE '$%' THEN TRY_CAST('0x' || replace(trim(lf.raw_max), '$', '') AS BIGINT)
    WHEN regexp_full_match(trim(lf.raw_max), '[+-]?[0-9]+') THEN TRY_CAST(trim(lf.raw_max) AS BIGINT)
    END AS top
FROM extracted e
LEFT JOIN (SELECT DISTINCT family, model_year FROM linear) tl
  ON tl.family = e.family AND tl.model_year = e.model_year
LEFT JOIN (SELECT DISTINCT family, model_year FROM enums) te
  ON te.family = e.family AND te.model_year = e.model_year
LEFT JOIN linear_first lf ON e.type = 'L' AND lf.family = e.family AND lf.model_year = e.model_year
  AND lf.id = TRY_CAST(e.id AS BIGINT)
""",
    "labelled": """
SELECT s.*, CASE
  WHEN type = 'L' AND state = 'row' AND raw IS NOT NULL THEN (
    SELECT arg_min(b.encoding_name, b.row_ord) FROM linear_labels b
    WHERE b.family = s.family AND b.model_year = s.model_year AND b.id = s.id_number
      AND ((b.lo_text = b.hi_text AND b.lo_text = printf('$%02X', s.raw))
        OR (b.lo_text <> b.hi_text AND s.raw BETWEEN b.lo AND b.hi)))
  WHEN type = 'T' AND state = 'row' AND raw IS NOT NULL THEN coalesce(
    (SELECT arg_min(t.encoding_name, t.row_ord) FROM enums t
      WHERE t.family = s.family AND t.model_year = s.model_year AND t.id = s.id_number
        AND s.raw <= 15 AND trim(t.min) = printf('$%X', s.raw)),
    (SELECT arg_min(t.encoding_name, t.row_ord) FROM enums t
      WHERE t.family = s.family AND t.model_year = s.model_year AND t.id = s.id_number
        AND trim(t.min) = printf('$%02X', s.raw)))
  END AS label
FROM stated s
""",
    "valued": """
SELECT *, CASE
  WHEN error IS NOT NULL THEN 'Error: ' || error
  WHEN label IS NOT NULL THEN label
  WHEN type = 'L' AND state = 'bad_id'
    THEN 'Conv Error: invalid literal for int() with base 10: ''' || id || ''''
  WHEN type = 'L' AND state = 'row' THEN CASE
    WHEN top IS NOT NULL AND raw = 65535 AND top = 65534 THEN 'Invalid/Not Available'
    WHEN top IS NOT NULL AND raw = 65535 AND top < 65535 THEN 'Invalid/Sensor Error'
    WHEN top IS NOT NULL AND raw = 65534 AND top < 65534 THEN 'Not Initialized'
    WHEN top IS NOT NULL AND raw <> 65535 AND raw > top THEN 'Out of Range/Invalid'
    WHEN (factor IS NULL OR offset_b IS NULL) AND decimals > 0 THEN 'NaN'
    WHEN factor IS NULL OR offset_b IS NULL THEN 'Conv Error: cannot convert float NaN to integer'
    WHEN decimals > 0 THEN CAST(round_even(raw * factor + offset_b, CAST(decimals AS INTEGER)) AS VARCHAR)
    ELSE CAST(CAST(trunc(raw * factor + offset_b) AS BIGINT) AS VARCHAR) END
  WHEN type = 'T' AND state = 'bad_id'
    THEN printf('0x%X', raw) || ' (Conv Error: invalid literal for int() with base 10: ''' || id || ''')'
  WHEN type = 'T' AND state = 'row' THEN CASE
    WHEN contains(name, 'Present/Not present') THEN CASE WHEN raw = 1 THEN 'Present' ELSE 'Not present' END
    WHEN contains(name, 'Fault/No Fault') THEN CASE WHEN raw = 1 THEN 'Fault' ELSE 'No Fault' END
    WHEN contains(name, 'False / True') THEN CASE WHEN raw = 1 THEN 'True' ELSE 'False' END
    ELSE printf('0x%X', raw) || ' (No match)' END
  WHEN type = 'T' THEN printf('0x%X', raw)
  ELSE CAST(raw AS VARCHAR) END AS value
FROM labelled
""",
    "decoded": """
SELECT event_id, model_name, family, model_year, message, hex, ord, description, value, error, raw, byte, size, type,
  id, name, bp, bb, n, k, unit_text, len, layout_name, back, state, label,
  CASE WHEN type IN ('L', 'T') AND id IS NOT NULL THEN raw END AS raw_value
FROM valued
""",
}


def _of_long(sql: str) -> str:
    """The SQL of a view over the tables of the long fields."""
    return re.sub(r"\b(messages|fields|layouts|placed|checked)\b", r"long_\1", sql)


_VIEWS |= {
    "long_messages": fx.SQL_LONG_MESSAGES,
    "long_layouts": fx.SQL_LONG_LAYOUTS,
    "long_linear": fx.SQL_LONG_LINEAR,
    "long_enums": fx.SQL_LONG_ENUM,
    **{f"long_{name}": _of_long(_VIEWS[name]) for name in ("fields", "placed", "checked")},
    # Numbers of up to 128 bits; the bytes are summed up one by one.
    "long_numbers": """
SELECT *, CASE WHEN error IS NOT NULL THEN NULL
  WHEN k = 0 THEN list_reduce(list_transform(range(length(whole)), lambda i:
      CAST(CAST('0x' || substr(whole, i + 1, 1) AS UTINYINT) AS UHUGEINT) << CAST(4 * (length(whole) - 1 - i) AS UHUGEINT)),
      lambda a, b: a | b)
  ELSE
    ((list_reduce(list_transform(range(n + CASE WHEN after_run IS NULL THEN 0 ELSE 1 END), lambda i:
        CAST(CAST('0x' || substr(hex, 2 * (bp + i) + 1, 2) AS UTINYINT) AS UHUGEINT) << CAST(8 * i AS UHUGEINT)),
        lambda a, b: a | b) >> CAST(bb AS UHUGEINT)) & ((CAST(1 AS UHUGEINT) << CAST(8 * n AS UHUGEINT)) - 1))
    | ((CAST(CAST('0x' || before AS UTINYINT) AS UHUGEINT) & ((CAST(1 AS UHUGEINT) << CAST(k AS UHUGEINT)) - 1))
      << CAST(8 * n AS UHUGEINT)) END AS raw
FROM long_checked
""",
    "long_labelled": """
SELECT m.*, f.factor, f.offset_b, f.decimals, f.raw_max, f.id IS NOT NULL AS has_row,
  e.family IS NOT NULL AS has_tables,
  coalesce(nullif(ltrim(upper(CASE WHEN k = 0 THEN whole END), '0'), ''), '0') AS code,
  (SELECT arg_min(l.encoding_name, l.row_ord) FROM long_linear l
    WHERE l.family = m.family AND l.model_year = m.model_year AND m.type = 'L' AND l.id = TRY_CAST(m.id AS BIGINT)
      AND l.encoding_name IS NOT NULL AND m.raw IS NOT NULL
      AND lpad(coalesce(nullif(ltrim(upper(whole), '0'), ''), '0'), 32, '0')
        BETWEEN lpad(replace(l.raw_min, '$', ''), 32, '0') AND lpad(replace(l.raw_max, '$', ''), 32, '0')) AS range_label,
  (SELECT arg_min(t.encoding_name, t.row_ord) FROM long_enums t
    WHERE t.family = m.family AND t.model_year = m.model_year AND m.type = 'T' AND t.id = TRY_CAST(m.id AS BIGINT)
      AND m.raw IS NOT NULL AND t.min = '$' || lpad(ltrim(upper(whole), '0'), CAST(greatest(2, length(ltrim(upper(whole), '0'))) AS INTEGER), '0')
  ) AS code_label
FROM long_numbers m
LEFT JOIN (SELECT DISTINCT family, model_year FROM long_linear) e
  ON e.family = m.family AND e.model_year = m.model_year
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY family, model_year, id ORDER BY row_ord) AS rn
    FROM long_linear) WHERE rn = 1) f
  ON m.type = 'L' AND f.family = m.family AND f.model_year = m.model_year AND f.id = TRY_CAST(m.id AS BIGINT)
""",
    "long_valued": """
SELECT *, coalesce(range_label, code_label) AS label,
  CASE WHEN raw_max LIKE '$%' THEN lpad(replace(raw_max, '$', ''), 32, '0')
    WHEN raw_max IS NOT NULL THEN lpad(printf('%X', CAST(raw_max AS UBIGINT)), 32, '0') END < lpad(code, 32, '0') AS beyond,
  CAST(CAST(raw AS VARCHAR) AS DOUBLE) * factor + offset_b AS scaled
FROM long_labelled
""",
    "long_decoded": """
SELECT event_id, model_name, ord, description, CAST(raw AS VARCHAR) AS raw, error, CASE
  WHEN error IS NOT NULL THEN 'Error: ' || error
  WHEN label IS NOT NULL THEN label
  WHEN type = 'L' AND has_row THEN CASE
    WHEN beyond THEN 'Out of Range/Invalid'
    WHEN factor IS NULL THEN 'Conv Error: cannot convert float NaN to integer'
    WHEN decimals > 0 THEN CAST(round_even(scaled, CAST(decimals AS INTEGER)) AS VARCHAR)
    ELSE CAST(CAST(trunc(scaled) AS HUGEINT) AS VARCHAR) END
  WHEN type = 'T' AND id IS NOT NULL AND has_tables THEN CASE
    WHEN contains(name, 'False / True') THEN CASE WHEN raw = 1 THEN 'True' ELSE 'False' END
    ELSE '0x' || code || ' (No match)' END
  WHEN type = 'T' THEN '0x' || code
  ELSE CAST(raw AS VARCHAR) END AS value,
  CASE WHEN error IS NOT NULL OR label IS NOT NULL OR type = 'T' THEN NULL
    WHEN type = 'L' AND has_row THEN CASE WHEN beyond OR factor IS NULL THEN NULL
      WHEN decimals > 0 THEN round_even(scaled, CAST(decimals AS INTEGER)) ELSE trunc(scaled) + 0.0 END
    ELSE CAST(CAST(raw AS VARCHAR) AS DOUBLE) END AS num
FROM long_valued
""",
}
_ORDER = list(_VIEWS)


def _needs(sql: str) -> list[str]:
    return [name for name in _ORDER if re.search(rf"\b{name}\b", sql)]


def with_views(sql: str) -> str:
    """Put the views a query uses, and those they use, in front of it."""
    used: set[str] = set()
    todo = _needs(sql)
    while todo:
        name = todo.pop()
        if name not in used:
            used.add(name)
            todo += [n for n in _needs(_VIEWS[name]) if n != name]
    views = ", ".join(f"{name} AS ({_VIEWS[name].strip()})" for name in _ORDER if name in used)
    body = sql.strip()
    if body.startswith("WITH "):
        return f"WITH {views}, {body[5:]}"
    return f"WITH {views} {body}" if views else body


# --- operators over message rows -------------------------------------------

def _expected(message: str) -> str:
    return (
        f"(SELECT length FROM lengths l WHERE l.family = j.family "
        f"AND l.model_year = j.model_year AND l.message = '{message}')"
    )


_CHECKED_ROWS = f"""
SELECT j.*, {_expected('A')} AS ref_a, {_expected('B')} AS ref_b FROM joined j
"""
_OK_A = "coalesce(length(msg_a) = ref_a, FALSE)"
_OK_B = "coalesce(length(msg_b) = ref_b, FALSE)"
_DATA_LINE = "(contains(line, ',') AND (contains(line, '62') OR contains(line, 'E#3') OR contains(line, 'null')))"
_LINES = """
SELECT event_type AS file, event_id AS position,
  CASE WHEN event_id % 9 = 0 THEN CAST(1700000000000 + event_id AS VARCHAR)
    WHEN event_id % 9 = 1 THEN ',' || coalesce(msg_a, '') || ',' || coalesce(msg_b, '')
    WHEN event_id % 9 = 2 THEN CAST(1700000000000 + event_id AS VARCHAR) || ',' || coalesce(msg_a, 'null')
    ELSE CAST(1700000000000 + event_id AS VARCHAR) || ',' || coalesce(msg_a, '') || ','
      || coalesce(msg_b, '') END AS line
FROM telemetry
"""


def _typed(kind: str) -> str:
    return {"float": "TRY_CAST(value AS DOUBLE)", "int": "TRY_CAST(value AS INTEGER)"}.get(
        kind, "value"
    )


def _flattened(pick: str, rows: list[tuple] = fx.COLUMN_ROWS) -> str:
    columns = ", ".join(
        f"max(CASE WHEN d.message = '{m}' AND description = '{text}' AND {pick} "
        f"THEN {_typed(kind)} END) AS {name}"
        for m, text, kind, name in rows
    )
    return f"""
SELECT j.event_id, j.model_name, j.family, j.model_year, {columns}
FROM joined j LEFT JOIN decoded d ON d.event_id = j.event_id AND d.model_name = j.model_name
GROUP BY ALL
"""


_JSON_ERRORS = """
SELECT event_id, model_name, family, model_year, message,
  CASE WHEN coalesce(hex, '') = '' THEN 'Empty DDT string'
    WHEN NOT EXISTS (SELECT 1 FROM layouts l WHERE l.family = m.family
      AND l.model_year = m.model_year AND l.message = m.message)
    THEN 'Structure file not found: ' || family || '/' || model_year || '/DDT_BCM_' || message
      || '_' || family || '_' || model_year || '.json' END AS error
FROM messages m
"""

_SQL = {
    "artefact_inventory": """
SELECT DISTINCT substr(p_type, 1, 2) AS family, CAST(2024 + p_partkey % 3 AS VARCHAR) AS model_year,
  CASE p_partkey // 11 % 4 WHEN 0 THEN 'linear' WHEN 1 THEN 'enum' WHEN 2 THEN 'A001' ELSE 'B001' END AS artefact
FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0""",
    "linear_values_many_ranges": """
WITH read AS (
  SELECT event_id, model_name, CAST('0x' || substr(hex, 9, 4) AS BIGINT) AS raw FROM messages
  WHERE family = 'MA' AND model_year = '2025' AND message = 'A' AND length(hex) >= 10
    AND regexp_full_match(substr(hex, 9, 4), '[0-9A-Fa-f]+')
), named AS (
  SELECT raw, arg_min(p_name, p_partkey) AS label
  FROM (SELECT DISTINCT raw FROM read) JOIN part
    ON raw BETWEEN p_partkey * 7 % 65536 AND p_partkey * 7 % 65536 + p_size
  GROUP BY raw
)
SELECT event_id, model_name, 'A' AS message, 0 AS ord, r.raw, coalesce(label,
    CASE WHEN raw = 65535 AND top = 65534 THEN 'Invalid/Not Available' WHEN raw = 65535 AND top < 65535 THEN 'Invalid/Sensor Error'
      WHEN raw = 65534 AND top < 65534 THEN 'Not Initialized' WHEN raw <> 65535 AND raw > top THEN 'Out of Range/Invalid'
      ELSE CAST(round_even(raw * 0.1::DOUBLE, 1) AS VARCHAR) END) AS value
FROM read r LEFT JOIN named USING (raw),
  (SELECT arg_min(p_partkey * 7 % 65536 + p_size, p_partkey) AS top FROM part)""",
    "decode_long_fields": "SELECT event_id, model_name, ord, description, raw, value, error, num FROM long_decoded",
    "decode_long_fields_forms": """
SELECT form, event_id, model_name, description, value FROM long_decoded, (VALUES ('array'), ('wide')) AS v(form)""",
    "scan_projection": """
SELECT event_id, vin, app_timestamp, msg_a AS "DIAG_BCM_A", msg_b AS "DIAG_BCM_B" FROM telemetry""",
    "date_window": """
SELECT event_id, vin, dt FROM telemetry WHERE dt >= '2024-01-05' AND dt < '2024-01-20'""",
    "date_from": "SELECT event_id, vin, dt FROM telemetry WHERE dt >= '2024-01-25'",
    "parse_time": """
SELECT event_id, epoch(strptime(app_timestamp, '%Y-%m-%d %H:%M:%S'))::BIGINT % 86400 AS seconds,
  CAST(CAST(app_timestamp AS DATE) AS VARCHAR) AS day FROM telemetry""",
    "join_vehicle": "SELECT event_id, vin, family, model_year, model_name FROM joined",
    "any_message_present": """
SELECT event_id FROM telemetry
WHERE (msg_a IS NOT NULL AND msg_a <> 'E#1') OR (msg_b IS NOT NULL AND msg_b <> 'E#1')""",
    "validity_flags": f"""
SELECT event_id, model_name, length(msg_a) AS a_actual_len, ref_a AS a_reference_len,
  coalesce(msg_a IS NOT NULL AND msg_a <> 'E#1' AND length(msg_a) = ref_a, FALSE) AS a_is_valid,
  length(msg_b) AS b_actual_len, ref_b AS b_reference_len,
  coalesce(msg_b IS NOT NULL AND msg_b <> 'E#1' AND length(msg_b) = ref_b, FALSE) AS b_is_valid
FROM ({_CHECKED_ROWS})""",
    "all_valid": f"""
SELECT event_id, model_name FROM ({_CHECKED_ROWS})
WHERE length(msg_a) = ref_a AND length(msg_b) = ref_b AND msg_a <> 'E#1' AND msg_b <> 'E#1'""",
    "any_length_ok": f"""
SELECT event_id, model_name FROM ({_CHECKED_ROWS}) WHERE {_OK_A} OR {_OK_B}""",
    "length_columns": f"""
SELECT event_id, model_name, ref_a AS valid_length_a, {_OK_A} AS has_valid_length_a,
  ref_b AS valid_length_b, {_OK_B} AS has_valid_length_b, {_OK_A} AND {_OK_B} AS all_valid
FROM ({_CHECKED_ROWS})""",
    "valid_rows": f"""
SELECT event_id, model_name, msg_a, msg_b FROM ({_CHECKED_ROWS}) WHERE {_OK_A} AND {_OK_B}""",
    "prepare_family": f"""
SELECT event_id, model_name FROM ({_CHECKED_ROWS})
WHERE family = 'MA' AND {_OK_A} AND {_OK_B}""",
    "prepare_unknown": "SELECT event_id, model_name FROM joined WHERE family = 'HO'",
    "quality_marks": f"""
SELECT event_id, model_name,
  CASE WHEN CASE WHEN ref_a IS NULL THEN msg_a IS NOT NULL ELSE {_OK_A} END THEN 'x' ELSE '' END AS mark_a,
  CASE WHEN CASE WHEN ref_b IS NULL THEN msg_b IS NOT NULL ELSE {_OK_B} END THEN 'x' ELSE '' END AS mark_b
FROM ({_CHECKED_ROWS})""",
    "filter_totals": f"""
SELECT count(*) AS before, count_if({_OK_A} AND {_OK_B}) AS after,
  count(*) - count_if({_OK_A} AND {_OK_B}) AS removed FROM ({_CHECKED_ROWS})""",
    "length_stats": f"""
SELECT family, model_year, count(*) AS total_rows, count_if({_OK_A}) AS valid_a_count,
  count_if({_OK_B}) AS valid_b_count, count_if({_OK_A} AND {_OK_B}) AS all_valid_count
FROM ({_CHECKED_ROWS}) GROUP BY family, model_year""",
    "family_filter": """
SELECT event_id, model_name, family FROM joined WHERE family IN ('MA', 'BU') AND model_year = '2025'""",
    "not_null_message": "SELECT event_id, msg_a FROM telemetry WHERE msg_a IS NOT NULL",
    "clean_names": """
SELECT p_partkey, replace(regexp_replace(p_name || ' - ' || p_brand || '.' || p_type,
  '[^a-zA-Z0-9_]', '_', 'g'), '__', '_') AS clean_name FROM part""",
    "cast_columns": """
SELECT event_id, TRY_CAST(vin AS INTEGER) AS vin, TRY_CAST(voltage AS DOUBLE) AS voltage,
  TRY_CAST(event_type AS DOUBLE) AS event_type, epoch(CAST(app_timestamp AS TIMESTAMP))::BIGINT % 86400 AS seconds
FROM telemetry""",
    "run_columns": """
SELECT event_id, 'v1.0' AS pipeline_version, 'unknown' AS config_version FROM telemetry""",
    "family_counts": "SELECT family, model_year, count(*) AS count FROM joined GROUP BY ALL",
    "families": "SELECT DISTINCT family FROM joined",
    "sample_counts": """
SELECT family, count(*) AS count FROM (SELECT family, row_number() OVER (PARTITION BY family
  ORDER BY app_timestamp, event_id, model_name) AS rn FROM joined WHERE msg_a IS NOT NULL)
WHERE rn <= 50 GROUP BY family""",
    "keys_in_both": """
SELECT DISTINCT family, model_year FROM joined
INTERSECT SELECT DISTINCT family, model_year FROM layouts""",
    "missing_artefacts": """
SELECT p.family, p.model_year, coalesce(string_agg(a.artefact, ',' ORDER BY a.artefact)
    FILTER (WHERE i.family IS NULL), '') AS missing,
  count_if(i.family IS NULL) = 0 AS valid
FROM (SELECT DISTINCT family, model_year FROM joined) p
CROSS JOIN (VALUES ('linear'), ('enum'), ('A')) AS a(artefact)
LEFT JOIN (SELECT DISTINCT family, model_year, message AS artefact FROM layouts
  UNION SELECT DISTINCT family, model_year, 'linear' FROM linear
  UNION SELECT DISTINCT family, model_year, 'enum' FROM enums) i
ON i.family = p.family AND i.model_year = p.model_year AND i.artefact = a.artefact
GROUP BY p.family, p.model_year""",
    "forward_fill": """
SELECT event_id, vin, voltage, key_on,
  last_value(voltage IGNORE NULLS) OVER w AS voltage_reference,
  last_value(key_on IGNORE NULLS) OVER w AS key_on_reference
FROM telemetry WINDOW w AS (PARTITION BY vin ORDER BY app_timestamp, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "first_n_per_family": """
SELECT event_id, model_name, family FROM (SELECT *, row_number() OVER (PARTITION BY family
  ORDER BY app_timestamp, event_id, model_name) AS rn FROM joined
  WHERE msg_a IS NOT NULL AND family IN ('AU', 'MA', 'FU')) WHERE rn <= 50""",
    "row_chunks": """
SELECT event_id, model_name, family, model_year, (row_number() OVER (PARTITION BY family, model_year
  ORDER BY app_timestamp, event_id, model_name) - 1) // 100 AS chunk FROM joined""",
    "sort_by_time": "SELECT event_id, app_timestamp FROM telemetry ORDER BY app_timestamp, event_id",
    "first_rows": "SELECT event_id, app_timestamp FROM telemetry ORDER BY app_timestamp, event_id LIMIT 50",
    "union_of_samples": """
SELECT event_id, model_name, family FROM (SELECT *, row_number() OVER (PARTITION BY family
  ORDER BY app_timestamp, event_id, model_name) AS rn FROM joined WHERE family IN ('AU', 'MA'))
WHERE rn <= 100""",
    "zip_log_lines": f"""
SELECT s.file, s.ordinal, s.timestamp_ms, d.msg_a, d.msg_b FROM (
  SELECT file, TRY_CAST(trim(split_part(line, ',', 1)) AS BIGINT) AS timestamp_ms,
    row_number() OVER (PARTITION BY file ORDER BY position) AS ordinal FROM ({_LINES})
  WHERE TRY_CAST(trim(split_part(line, ',', 1)) AS BIGINT) IS NOT NULL) s
JOIN (SELECT file, split_part(line, ',', 2) AS msg_a, split_part(line, ',', 3) AS msg_b,
    row_number() OVER (PARTITION BY file ORDER BY position) AS ordinal FROM ({_LINES})
  WHERE {_DATA_LINE}) d ON s.file = d.file AND s.ordinal = d.ordinal""",
    "unpivot_messages": "SELECT event_id, model_name, family, model_year, message, hex FROM messages",
    "positions": """
SELECT p_partkey, CAST(regexp_extract(b, '^(\\d+)', 1) AS INTEGER) AS byte_pos,
  coalesce(TRY_CAST(regexp_extract(b, '\\[(\\d+)\\]', 1) AS INTEGER), 0) AS bit_pos FROM (
  SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN CAST(p_size AS VARCHAR)
    ELSE p_size || ' [' || (p_partkey % 8) || ']' END AS b FROM part)""",
    "decode_long": """
SELECT event_id, model_name, family, model_year, message, ord, description, value, error, raw FROM decoded""",
    "decode_records": """
SELECT event_id, model_name, message, ord, description, value AS decoded_value, byte AS raw_position,
  size, type AS msg_type, id AS msg_id, raw_value, unit_text AS units FROM decoded WHERE back = 1""",
    "decode_first_wins": """
SELECT event_id, model_name, message, description, value FROM (SELECT *, row_number() OVER (PARTITION BY
  event_id, model_name, message, description ORDER BY ord) AS front FROM decoded) WHERE front = 1""",
    "decode_bits": """
SELECT event_id, model_name, message, ord, raw, error FROM decoded WHERE n = 0 AND k > 0""",
    "decode_whole": """
SELECT event_id, model_name, message, ord, raw, error FROM decoded WHERE n > 0 AND k = 0""",
    "decode_mixed": """
SELECT event_id, model_name, message, ord, raw, error FROM decoded WHERE k > 0 AND n > 0 OR n = 0 AND k = 0""",
    "linear_values": """
SELECT event_id, model_name, message, ord, raw, value FROM decoded WHERE type = 'L' AND error IS NULL""",
    "enum_values": """
SELECT event_id, model_name, message, ord, raw, value FROM decoded WHERE type = 'T' AND error IS NULL""",
    "enum_strict": """
SELECT event_id, model_name, message, ord, raw, CASE WHEN state <> 'row' THEN value ELSE coalesce(
    (SELECT arg_min(t.encoding_name, t.row_ord) FROM enums t WHERE t.family = d.family
      AND t.model_year = d.model_year AND t.id = TRY_CAST(d.id AS BIGINT)
      AND d.raw <= 9 AND trim(t.min) = printf('$%X', d.raw)),
    (SELECT arg_min(t.encoding_name, t.row_ord) FROM enums t WHERE t.family = d.family
      AND t.model_year = d.model_year AND t.id = TRY_CAST(d.id AS BIGINT)
      AND (d.raw = 0 OR d.raw > 9) AND trim(t.min) = printf('$%02X', d.raw)),
    CASE WHEN contains(name, 'Present/Not present') THEN CASE WHEN raw = 1 THEN 'Present' ELSE 'Not present' END
      WHEN contains(name, 'Fault/No Fault') THEN CASE WHEN raw = 1 THEN 'Fault' ELSE 'No Fault' END
      WHEN contains(name, 'False / True') THEN CASE WHEN raw = 1 THEN 'True' ELSE 'False' END
      ELSE printf('0x%X', raw) || ' (No match)' END) END AS value
FROM decoded d WHERE type = 'T' AND error IS NULL
  AND EXISTS (SELECT 1 FROM linear l WHERE l.family = d.family AND l.model_year = d.model_year)
  AND EXISTS (SELECT 1 FROM enums e WHERE e.family = d.family AND e.model_year = d.model_year)""",
    "field_errors": """
SELECT message, description, error, count(*) AS n FROM decoded WHERE error IS NOT NULL GROUP BY ALL""",
    "decode_null_mode": """
SELECT event_id, model_name, message, hex IS NOT NULL AND EXISTS (SELECT 1 FROM layouts l
  WHERE l.family = m.family AND l.model_year = m.model_year AND l.message = m.message) AS decoded,
  CASE WHEN hex IS NOT NULL THEN (SELECT max(layout_name) FROM layouts l WHERE l.family = m.family
    AND l.model_year = m.model_year AND l.message = m.message) END AS name
FROM messages m""",
    "decode_envelope_mode": _JSON_ERRORS,
    "decode_tables_required": """
SELECT event_id, model_name, message, hex IS NOT NULL AND EXISTS (SELECT 1 FROM linear l
  WHERE l.family = m.family AND l.model_year = m.model_year) AS decoded FROM messages m""",
    "flatten_wide": _flattened("back = 1"),
    "flatten_pivot": _flattened("back = 1") + " HAVING count(d.event_id) > 0",
    "flatten_json_map": _flattened("back = 1"),
    "flatten_json_list": _flattened(
        "ord = (SELECT min(x.ord) FROM layouts x WHERE x.family = d.family AND x.model_year = d.model_year "
        "AND x.message = d.message AND x.description = d.description)"
    ),
    "flatten_by_position": """
SELECT j.event_id, j.model_name, j.family, j.model_year, max(CASE WHEN ord = 3 THEN TRY_CAST(value AS DOUBLE) END) AS level,
  max(CASE WHEN ord = 15 THEN value END) AS state FROM joined j
LEFT JOIN decoded d ON d.event_id = j.event_id AND d.model_name = j.model_name AND d.message = 'A'
GROUP BY j.event_id, j.model_name, j.family, j.model_year""",
    "props_json": """
SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k,
  '{"k":"' || (props ->> '$.k') || '"}' AS again FROM events""",
    "union_by_name": """
SELECT event_id, msg_a, NULL AS msg_b, NULL AS voltage FROM telemetry
UNION ALL SELECT event_id, NULL, msg_b, NULL FROM telemetry
UNION ALL SELECT event_id, NULL, NULL, voltage FROM telemetry""",
    "union_by_position": """
SELECT event_id, msg_a AS hex FROM telemetry UNION ALL SELECT event_id, msg_b FROM telemetry""",
    "union_bag": """
SELECT event_id, vin FROM telemetry UNION ALL SELECT event_id, vin FROM telemetry""",
    "error_counts": f"""
SELECT 'decoded_' || message AS "column", count(*) AS error_count FROM ({_JSON_ERRORS})
WHERE error IS NOT NULL GROUP BY message""",
    "decoding_summary": f"""
WITH e AS ({_JSON_ERRORS})
SELECT 'total_rows' AS metric, '' AS key, count(*) AS value FROM joined
UNION ALL SELECT 'family', family || '-' || model_year, count(*) FROM joined GROUP BY family, model_year
UNION ALL SELECT 'errors', 'decoded_' || message, count(*) FROM e WHERE error IS NOT NULL GROUP BY message
UNION ALL SELECT 'total_columns', '', 6 UNION ALL SELECT 'decoded_json_columns', '', 2
UNION ALL SELECT 'flattened_data_columns', '', 2""",
    "quality_report": f"""
SELECT count(DISTINCT message) AS columns_with_errors, 2 AS decoded_columns,
  (2 - count(DISTINCT message)) * 100.0::DOUBLE / 2 AS success_rate,
  printf('%.1f%%', (2 - count(DISTINCT message)) * 100.0::DOUBLE / 2) AS success_rate_text
FROM ({_JSON_ERRORS}) WHERE error IS NOT NULL""",
    "inspect_fields": """
SELECT event_id, model_name, message, ord, description, value, byte AS raw_position, size, type AS msg_type,
  coalesce(id, 'N/A') AS msg_id, coalesce(CAST(raw_value AS VARCHAR), 'N/A') AS raw_value,
  CASE WHEN hi < lo THEN 'N/A' ELSE substr(hex, 2 * lo + 1, 2 * (hi - lo + 1)) END AS raw_hex,
  CASE WHEN hi < lo THEN 'N/A'
    WHEN n = 0 AND k > 0 THEN CASE WHEN regexp_full_match(substr(hex, 2 * bp + 1, 2), '[0-9A-Fa-f]+')
      THEN lpad(bin((CAST('0x' || substr(hex, 2 * bp + 1, 2) AS BIGINT) >> bb) & ((1 << k) - 1)),
        greatest(k, length(bin((CAST('0x' || substr(hex, 2 * bp + 1, 2) AS BIGINT) >> bb) & ((1 << k) - 1))))::INT, '0') END
    ELSE array_to_string(list_filter(list_transform(range(lo, hi + 1), lambda i:
      CASE WHEN regexp_full_match(substr(hex, 2 * i + 1, 2), '[0-9A-Fa-f]+')
        THEN lpad(bin(CAST('0x' || substr(hex, 2 * i + 1, 2) AS BIGINT)), 8, '0') END),
      lambda x: x IS NOT NULL), ' ') END AS binary
FROM (SELECT *, CASE WHEN n > 0 AND k > 0 THEN greatest(bp - 1, 0) ELSE bp END AS lo,
  least(bp + greatest(n, 1) - 1, len // 2 - 1) AS hi FROM decoded)""",
    "inspect_bytes": """
SELECT b.event_id, b.model_name, b.message, b.byte_index, substr(b.hex, 2 * b.byte_index + 1, 2) AS raw_hex,
  CASE WHEN regexp_full_match(substr(b.hex, 2 * b.byte_index + 1, 2), '[0-9A-Fa-f]+')
    THEN lpad(bin(CAST('0x' || substr(b.hex, 2 * b.byte_index + 1, 2) AS BIGINT)), 8, '0') END AS binary,
  coalesce(string_agg(d.value, '|' ORDER BY d.ord), '') AS decoded_values,
  coalesce(string_agg(CASE WHEN length(d.description) > 30 THEN substr(d.description, 1, 30) || '...'
    ELSE d.description END || CASE WHEN d.type IN ('L', 'T') THEN ' (' || d.type || ')' ELSE '' END,
    '|' ORDER BY d.ord), '') AS descriptions
FROM (SELECT m.*, CAST(unnest(range(length(hex) // 2)) AS INTEGER) AS byte_index FROM messages m WHERE hex IS NOT NULL
  AND EXISTS (SELECT 1 FROM layouts l WHERE l.family = m.family AND l.model_year = m.model_year
    AND l.message = m.message)) b
LEFT JOIN decoded d ON d.event_id = b.event_id AND d.model_name = b.model_name AND d.message = b.message
  AND b.byte_index BETWEEN CASE WHEN d.n > 0 AND d.k > 0 THEN d.bp - 1 ELSE d.bp END
    AND d.bp + greatest(d.n, 1) - 1
GROUP BY b.event_id, b.model_name, b.message, b.byte_index, b.hex""",
    "batch_decode": f"""
SELECT f.event_id, f.model_name, f.family, f.model_year, p.voltage_reference, f.charge, f.level,
  f.state, f.counter FROM ({_flattened("back = 1")}) f
JOIN (SELECT c.event_id, c.model_name, r.voltage_reference FROM ({_CHECKED_ROWS}) c JOIN (
    SELECT event_id, last_value(voltage IGNORE NULLS) OVER (PARTITION BY vin ORDER BY app_timestamp, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS voltage_reference FROM telemetry) r ON r.event_id = c.event_id
  WHERE {_OK_A} AND {_OK_B}) p
ON p.event_id = f.event_id AND p.model_name = f.model_name""",
    "sink_overwrite": "SELECT event_id, vin, msg_a FROM telemetry",
    "sink_append_merge": """
SELECT event_id, vin, msg_a, NULL AS msg_b FROM telemetry
UNION ALL SELECT event_id, vin, NULL, msg_b FROM telemetry""",
    "sink_with_summary": """
SELECT 'total_rows' AS metric, '' AS key, count(*) AS value FROM joined
UNION ALL SELECT 'family', family || '-' || model_year, count(*) FROM joined GROUP BY family, model_year
UNION ALL SELECT 'total_columns', '', 4 UNION ALL SELECT 'decoded_json_columns', '', 0
UNION ALL SELECT 'flattened_data_columns', '', 1""",
    "report_lines": """
SELECT '- ' || family || '-' || model_year || ': ' || count(*) || ' rows' AS value FROM joined
GROUP BY family, model_year
UNION ALL SELECT '- total_rows: ' || count(*) FROM joined
UNION ALL SELECT '- total_columns: 3' UNION ALL SELECT '- decoded_json_columns: 0'
UNION ALL SELECT '- flattened_data_columns: 1'""",
    "linear_csv": """
SELECT substr(p_type, 1, 2) AS family, CAST(2024 + p_partkey % 3 AS VARCHAR) AS model_year,
  CAST(p_size AS BIGINT) AS id, row_number() OVER (PARTITION BY substr(p_type, 1, 2), p_partkey % 3,
    p_partkey // 500 ORDER BY p_partkey) - 1 AS row_ord, p_retailprice AS factor,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE -1.5 END AS "offset",
  CASE WHEN p_partkey % 5 < 2 THEN 0 ELSE 3 END AS decimals,
  p_brand AS units, '$00' AS raw_min, printf('$%04X', p_partkey % 65536) AS raw_max,
  CASE WHEN p_partkey % 7 = 0 THEN p_name END AS encoding_name FROM part""",
    "enum_csv": """
SELECT substr(p_type, 1, 2) AS family, CAST(2024 + p_partkey % 3 AS VARCHAR) AS model_year,
  CAST(p_size AS BIGINT) AS id, row_number() OVER (PARTITION BY substr(p_type, 1, 2), p_partkey % 3,
    p_partkey // 500 ORDER BY p_partkey) - 1 AS row_ord,
  printf('$%X', p_partkey % 300) AS min, p_name AS encoding_name FROM part""",
    "layout_from_csv": """
SELECT substr(p_brand, 7) || '-' || (p_partkey // 500) AS message,
  CAST(row_number() OVER (PARTITION BY p_brand, p_partkey // 500 ORDER BY p_partkey) - 1 AS INTEGER) AS ord,
  p_size || ' [' || (p_partkey % 8) || ']' AS byte, p_name AS description, '1 [0]' AS size, 'L' AS type,
  p_type AS name, CAST(p_partkey AS VARCHAR) AS id,
  CASE WHEN p_partkey % 3 = 0 THEN 'd' || p_size END AS default_value FROM part""",
    "layout_legacy_csv": """
SELECT p_partkey % 4 AS part_no, CAST(row_number() OVER (PARTITION BY p_partkey % 4, p_partkey // 500
    ORDER BY p_partkey) - 1 AS INTEGER) AS ord,
  p_size || ' [0]' AS byte, p_name AS description, '1 [0]' AS size, NULL AS type,
  p_type AS name, CAST(p_partkey AS VARCHAR) AS id FROM part""",
    "config_documents": """
SELECT 'M' || p_partkey AS message, p_name AS description, 'float' AS type,
  replace(p_name, ' ', '_') AS clean_name, substr(p_type, 1, 2) AS family,
  CAST(2024 + p_partkey % 3 AS VARCHAR) AS model_year, p_size AS length FROM part""",
    "message_log": """
SELECT 1700000000000 + event_id AS timestamp_ms, 1700000000 + event_id // 1000 AS seconds, message,
  nullif(hex, '') AS hex FROM (SELECT event_id, 'msg_a' AS message, msg_a AS hex FROM telemetry
    UNION ALL SELECT event_id, 'msg_b', msg_b FROM telemetry)""",
    "layout_mixed_csv": """
SELECT p_size || ' [0]' AS byte, p_name AS description, '1 [0]' AS size,
  CASE WHEN p_partkey % 3 < 2 THEN 'L' END AS type, p_type AS name, CAST(p_partkey AS VARCHAR) AS id,
  CASE WHEN p_partkey % 6 = 1 THEN 'd' || p_partkey END AS default_value FROM part""",
    "layout_tree": """
SELECT CASE p_partkey % 5 WHEN 4 THEN 'FU' ELSE 'MA' END AS family,
  CASE p_partkey % 5 WHEN 4 THEN '2026' ELSE '2025' END AS model_year,
  CASE p_partkey % 5 WHEN 1 THEN 'B001' ELSE 'A001' END AS message, 'n' AS layout_name,
  CAST(row_number() OVER (PARTITION BY p_partkey % 5 ORDER BY p_partkey) - 1 AS INTEGER) AS ord,
  p_name AS description, p_type AS name, CAST(p_partkey AS VARCHAR) AS id
FROM part WHERE p_partkey % 5 IN (0, 1, 4)""",
    "stage_table": "SELECT event_id, model_name, family, msg_a FROM joined",
}


_OF_MESSAGE = ", ".join(
    f"CASE WHEN {_OK_A if row[0] == 'A' else _OK_B} THEN f.{row[3]} END AS {row[3]}" for row in fx.COLUMN_ROWS
)
_SQL |= {
    "flatten_wide_array": _SQL["flatten_wide"],
    "zip_log_files": _SQL["zip_log_lines"],
    "forward_fill_minute": _SQL["forward_fill"],
    "date_by_pattern": """
SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN dt END AS day FROM telemetry""",
    "discovered_messages": """
SELECT event_id, 'A001' AS message, msg_a AS hex FROM telemetry
UNION ALL SELECT event_id, 'B_2', msg_b FROM telemetry""",
    "sample_row": "SELECT event_id, vin, dt FROM telemetry WHERE event_id = (SELECT max(event_id) FROM telemetry)",
    "described_fields": """
SELECT l.family, l.model_year, l.message, l.description, l.ord AS position FROM layouts l
JOIN (SELECT DISTINCT family, model_year FROM joined) j ON j.family = l.family AND j.model_year = l.model_year
WHERE l.description <> 'Reserved'""",
    "flatten_by_position_all": f"""
SELECT * EXCLUDE (absent) FROM ({_flattened("d.ord < 29")})""",
    "flatten_messages": f"""
SELECT * EXCLUDE (family, model_year) FROM ({_flattened("back = 1", fx.FLAT_COLUMNS)})""",
    "envelope_bodies": """
SELECT event_id, model_name, ord, hex AS code, layout_name AS name, family AS vehicle_family, model_year,
  message AS ddt_type, description, value AS decoded_value, byte AS raw_position, size, type AS msg_type, id AS msg_id,
  raw_value, CASE WHEN type = 'L' AND state = 'row' THEN unit_text END AS units FROM decoded""",
    "envelope_reasons": f"""
SELECT event_id, model_name, message, error FROM ({_JSON_ERRORS})
UNION ALL SELECT event_id, model_name, 'E', CASE WHEN coalesce(hex, '') = '' THEN 'Empty DDT string'
  WHEN NOT EXISTS (SELECT 1 FROM layouts l WHERE l.family = m.family AND l.model_year = m.model_year)
    THEN 'Structure file not found: ' || family || '/' || model_year || '/DDT_BCM_E_' || family || '_' || model_year || '.json'
  ELSE 'Empty structure for E' END FROM messages m WHERE message = 'A'
UNION ALL SELECT event_id, model_name, 'U', CASE WHEN coalesce(hex, '') = '' THEN 'Empty DDT string'
  ELSE 'DDT file mapping not found for U' END FROM messages WHERE message = 'B'""",
    "forward_fill_by_data": _SQL["forward_fill"],
    "row_chunks_by_data": _SQL["row_chunks"],
    "sink_decoded_with_summary": _SQL["decoding_summary"],
    "sink_rows_with_metadata": """
SELECT vin, family, model_year, event_id, model_name, 'v1.0' AS pipeline_version, 'c7' AS config_version, TRUE AS stamped
FROM joined""",
    "report_body": f"""
WITH e AS ({_JSON_ERRORS}), bad AS (SELECT count(DISTINCT message) AS n FROM e WHERE error IS NOT NULL)
SELECT 'summary' AS section, 'total_rows' AS key, CAST(count(*) AS VARCHAR) AS value FROM joined
UNION ALL SELECT 'families', family || '-' || model_year, CAST(count(*) AS VARCHAR) FROM joined GROUP BY family, model_year
UNION ALL SELECT 'errors', 'decoded_' || message, CAST(count(*) AS VARCHAR) FROM e WHERE error IS NOT NULL GROUP BY message
UNION ALL SELECT 'summary', 'total_columns', '6' UNION ALL SELECT 'summary', 'decoded_json_columns', '2'
UNION ALL SELECT 'summary', 'flattened_data_columns', '1'
UNION ALL SELECT 'errors', '', 'No errors found' FROM bad WHERE n = 0
UNION ALL SELECT 'quality', 'error_rate', n || '/2 columns have errors' FROM bad
UNION ALL SELECT 'quality', 'success_rate', printf('%.1f%%', (2 - n) * 100.0::DOUBLE / 2) FROM bad""",
    "report_body_without_errors": """
SELECT 'summary' AS section, 'total_rows' AS key, CAST(count(*) AS VARCHAR) AS value FROM joined
UNION ALL SELECT 'families', family || '-' || model_year, CAST(count(*) AS VARCHAR) FROM joined GROUP BY family, model_year
UNION ALL SELECT 'summary', 'total_columns', '3' UNION ALL SELECT 'summary', 'decoded_json_columns', '0'
UNION ALL SELECT 'summary', 'flattened_data_columns', '1'
UNION ALL SELECT 'errors', '', 'No errors found'
UNION ALL SELECT 'quality', 'error_rate', '0/0 columns have errors'
UNION ALL SELECT 'quality', 'success_rate', 'N/A'""",
    "table_overwrite_partition": """
SELECT event_id, model_name, family, model_year,
  CASE WHEN family = 'MA' AND model_year = '2025' THEN NULL ELSE msg_a END AS msg_a,
  CASE WHEN family = 'MA' AND model_year = '2025' THEN 'second' END AS run FROM joined""",
    "stage_by_day": """
SELECT event_id, model_name, dt, family, msg_a FROM joined WHERE dt >= '2024-01-05' AND dt < '2024-01-20'""",
    "decode_when_valid": f"""
SELECT f.event_id, f.model_name, {_OF_MESSAGE} FROM ({_flattened("back = 1")}) f
JOIN ({_CHECKED_ROWS}) c ON c.event_id = f.event_id AND c.model_name = f.model_name""",
    "first_n_large": """
SELECT event_id, model_name, family FROM joined
QUALIFY row_number() OVER (PARTITION BY family ORDER BY app_timestamp, event_id, model_name) <= 1500""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in _SQL.items()}