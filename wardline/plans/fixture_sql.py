"""The fixture projections of ``wardline.sources.fixtures`` as DuckDB SQL.

Used only by the oracle check: each oracle query is ``WITH <fixtures> <body>``
over the driver's pre-registered tables.
"""

from __future__ import annotations

from wardline.functions.scalar import PY_FLOAT_RE, _ISO_RE


def pid(x: str) -> str:
    return f"('P' || lpad(cast({x} as varchar), 6, '0'))"


_K8 = "(cast(json_extract_string(props, '$.k') as integer) % 8)"
_V = "cast(value as decimal(10,2))"


def _value_text() -> str:
    rules = ["15 + v % 150", "40 + v * 1.5", "15 + v", "101 - v * 0.25", "2 + v * 0.35", "95 + v * 0.1"]
    whens = " ".join(f"WHEN {i} THEN cast(cast({r.replace('v', _V)} as decimal(10,2)) as varchar)"
                     for i, r in enumerate(rules))
    return f"CASE {_K8} {whens} ELSE cast({_V} as varchar) END"


_CODES = ["8867-4", "8480-6", "8462-4", "2708-6", "9279-1", "8310-5"]
_DESCS = ["Heart Rate", "Systolic Blood Pressure", "Diastolic Blood Pressure", "Oxygen Saturation",
          "Respiratory Rate", "Body Temperature"]
_UNITS = ["/min", "mm[Hg]", "mm[Hg]", "%", "/min", "degF"]


def _case_k8(vals: list[str], default: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(vals))
    return f"CASE {_K8} {whens} ELSE '{default}' END"


_LINE_ORDER = ("l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, "
               "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus")

PY_FLOAT = PY_FLOAT_RE
ISO = _ISO_RE

FIXTURES: dict[str, tuple[list[str], str]] = {
    "patients": ([], f"""
        SELECT {pid('c_custkey')} AS Id,
               strftime(DATE '1930-01-01' + cast(c_custkey * 37 % 29000 as integer), '%Y-%m-%d') AS BIRTHDATE,
               CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS GENDER,
               c_mktsegment AS MARITAL
        FROM customer WHERE c_custkey % 17 <> 16"""),
    "observations": ([], f"""
        SELECT event_id AS rec_offset, ts AS ingest_ts, {pid('user_id')} AS PATIENT,
               'E' || cast(event_id as varchar) AS ENCOUNTER,
               CASE WHEN event_id % 109 = 0 THEN '' WHEN event_id % 113 = 0 THEN 'not-a-date'
                    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS DATE,
               {_case_k8(_CODES, '29463-7')} AS CODE,
               {_case_k8(_DESCS, 'Body Weight')} AS DESCRIPTION,
               CASE WHEN event_id % 101 = 0 THEN '' WHEN event_id % 103 = 0 THEN 'N/A'
                    WHEN event_id % 107 = 0 THEN 'nan' ELSE {_value_text()} END AS VALUE,
               {_case_k8(_UNITS, 'kg')} AS UNITS,
               CASE WHEN event_type = 'click' THEN 'csv_lab_export' WHEN event_type = 'view' THEN 'jdbc_postgres'
                    ELSE 'debezium_mysql' END AS source_system
        FROM events"""),
    "_lines_even": ([], f"""
        SELECT *, cast(row_number() OVER (PARTITION BY o_custkey ORDER BY {_LINE_ORDER}) as bigint) AS rec_offset
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        WHERE l_linenumber % 2 = 0"""),
    "_lines_odd": ([], f"""
        SELECT *, cast(row_number() OVER (PARTITION BY o_custkey ORDER BY {_LINE_ORDER}) as bigint) AS rec_offset
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        WHERE l_linenumber % 2 = 1"""),
    "conditions": (["_lines_even"], f"""
        SELECT rec_offset, {pid('o_custkey')} AS patient_id, p_type AS condition_code,
               p_type || ' ' || p_brand AS condition_name,
               CASE WHEN l_linestatus = 'O' THEN 'active' ELSE 'resolved' END AS status,
               CASE WHEN l_returnflag = 'R' THEN 'severe' WHEN l_returnflag = 'A' THEN 'moderate' ELSE 'mild' END
                 AS severity,
               l_shipdate AS updated_at
        FROM _lines_even"""),
    "medications": (["_lines_odd"], f"""
        SELECT rec_offset, {pid('o_custkey')} AS patient_id, p_name AS medication_name,
               cast(cast(trunc(l_quantity) as integer) as varchar) || 'mg' AS dosage,
               'daily' AS frequency, 'oral' AS route, 'active' AS status,
               CASE WHEN l_partkey % 20 = 0 THEN 'd' WHEN l_partkey % 20 <= 5 THEN 'u' ELSE 'c' END AS op,
               l_shipdate AS updated_at
        FROM _lines_odd"""),
    "stays": ([], f"""
        SELECT o_orderkey AS encounter_id, {pid('o_custkey')} AS patient_id, o_orderdate AS admit_time,
               o_orderdate + to_days(cast(o_orderkey % 7 + 1 as integer)) AS discharge_time,
               o_totalprice AS total_claim_cost,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN '  '
                    ELSE o_orderpriority END AS reasondescription
        FROM orders"""),
    "status_events": ([], """
        SELECT event_type AS component, cast(user_id % 3 as integer) AS task_id,
               CASE WHEN k < 5 THEN 'FAILED' WHEN k < 10 THEN 'PAUSED' ELSE 'RUNNING' END AS state,
               event_id AS rec_offset, ts
        FROM (SELECT *, cast(json_extract_string(props, '$.k') as integer) AS k FROM events)"""),
    "topic_log": ([], f"""
        SELECT event_type AS topic, cast(user_id % 6 as integer) AS "partition",
               cast(row_number() OVER (PARTITION BY event_type, user_id % 6 ORDER BY event_id) - 1 as bigint)
                 AS "offset",
               {pid('user_id')} AS "key",
               CASE WHEN event_id % 97 = 0 THEN NULL ELSE props END AS "value", ts
        FROM events"""),
    "schema_versions": ([], """
        SELECT p_brand AS subject, p_size AS version, p_partkey AS id, 'AVRO' AS schema_type FROM part"""),
    # validator: one left join, reason by first failing check
    "_classified0": (["observations", "patients"], """
        SELECT o.*, p.Id AS _pid, p.BIRTHDATE AS _birthdate, p.GENDER AS _gender,
               o.CODE IN ('8867-4','8480-6','8462-4','2708-6','9279-1','8310-5') AS is_vital,
               regexp_replace(coalesce(o.VALUE, ''), '^\\s+|\\s+$', '', 'g') AS _s,
               CASE o.CODE WHEN '8867-4' THEN 20 WHEN '8480-6' THEN 50 WHEN '8462-4' THEN 20
                    WHEN '2708-6' THEN 50 WHEN '9279-1' THEN 4 WHEN '8310-5' THEN 90 END AS _lo,
               CASE o.CODE WHEN '8867-4' THEN 250 WHEN '8480-6' THEN 300 WHEN '8462-4' THEN 200
                    WHEN '2708-6' THEN 100 WHEN '9279-1' THEN 60 WHEN '8310-5' THEN 110 END AS _hi
        FROM observations o LEFT JOIN patients p ON o.PATIENT = p.Id"""),
    "_classified1": (["_classified0"], f"""
        SELECT *, CASE WHEN regexp_full_match(_s, '{PY_FLOAT}')
                       THEN try_cast(replace(_s, '_', '') as double) END AS num_value
        FROM _classified0"""),
    "classified": (["_classified1"], """
        SELECT * EXCLUDE (_s, _lo, _hi),
          CASE WHEN NOT is_vital THEN NULL
               WHEN _s = '' THEN 'MISSING_VALUE: VALUE field is empty'
               WHEN num_value IS NULL THEN 'INVALID_VALUE: Cannot parse ''' || _s || ''' as number'
               WHEN _lo IS NOT NULL AND NOT isnan(num_value) AND (num_value < _lo OR num_value > _hi)
                 THEN 'OUT_OF_RANGE: ' || CODE || ' value ' || cast(num_value as varchar)
                      || ' outside valid range [' || cast(_lo as varchar) || ', ' || cast(_hi as varchar) || ']'
               WHEN _pid IS NULL THEN 'UNKNOWN_PATIENT: Patient ' || substr(coalesce(PATIENT, ''), 1, 8)
                      || '... not in patients.csv'
               WHEN coalesce(DATE, '') = '' THEN 'MISSING_DATE: DATE field is empty'
          END AS error_reason
        FROM _classified1"""),
    "enriched": (["classified"], f"""
        SELECT PATIENT AS patient_id, ENCOUNTER AS encounter_id, DATE AS "timestamp", CODE AS vital_type,
               DESCRIPTION AS vital_description, num_value AS value, coalesce(UNITS, '') AS units,
               cast(CASE WHEN _b IS NULL OR _r IS NULL THEN -1
                    ELSE greatest(0, least(120, year(_r) - year(_b) - CASE WHEN month(_r) < month(_b)
                         OR (month(_r) = month(_b) AND day(_r) < day(_b)) THEN 1 ELSE 0 END)) END as integer)
                 AS patient_age,
               _gender AS patient_gender, 'csv_lab_export' AS source_system, rec_offset, ingest_ts
        FROM (SELECT *, cast(try_strptime(_birthdate, '%Y-%m-%d') as date) AS _b,
                     CASE WHEN regexp_full_match(DATE, '{ISO}')
                          THEN cast(try_strptime(substr(DATE, 1, 10), '%Y-%m-%d') as date) END AS _r
              FROM classified WHERE is_vital AND error_reason IS NULL)"""),
    "rejected": (["classified"], """
        SELECT * FROM classified WHERE is_vital AND error_reason IS NOT NULL"""),
}


def with_fixtures(body: str, *names: str) -> str:
    """``WITH`` clause holding the named fixtures (and what they depend on)."""
    order: list[str] = []

    def add(n: str) -> None:
        deps, _ = FIXTURES[n]
        for dd in deps:
            add(dd)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({FIXTURES[n][1]}\n)" for n in order)
    # a body starting with "," adds its own CTEs to the list
    sep = "" if body.lstrip().startswith(",") else "\n"
    return f"WITH {ctes}{sep}{body}"


def add_fixture(name: str, deps: list[str], sql: str) -> None:
    FIXTURES[name] = (deps, sql)
