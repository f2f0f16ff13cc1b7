"""

Written on the driver tables themselves, without the surrogate-key joins of
the Spark plans: a code is recognised by its text in one ``codebook``, dates
are compared as dates, date keys are computed from the date, and each
encounter is reduced to one row of facts (``visit``) by a single grouped pass
over its diagnosis lines and one over its procedures. Every query is then a
filter or count of ``visit``, ``dx`` or ``px``.
"""

from __future__ import annotations

YEAR = 1997

#: Fixed values of the fixture (FIXTURES.md): list, kind, prefix, modulus of
#: the part key, first and last residue, identifier.
LISTS = [
    ("appendix_a", "Procedure", "P", 10, 0, 3, "ORPROC"),
    ("appendix_e", "DRG", "", 50, 0, 29, "SURGI2R"),
    ("appendix_f", "Diagnosis", "D", 100, 0, 7, "INFECID"),
    ("appendix_o", "Diagnosis", "D", 100, 20, 29, "MDC14PRINDX"),
    ("appendix_o", "Diagnosis", "D", 100, 25, 34, "MDC15PRINDX"),
    ("sepsis_codes", "Diagnosis", "D", 100, 5, 12, "SEPTI2D"),
]
VERSION_YEARS = (1995, 2001)
FIRST_DAY, LAST_DAY = "1850-01-01", "2030-12-31"

ROLLING = ("1996-07-01", "1997-06-30")
ROLLING_PREV = ("1996-06-01", "1997-05-31")
BACKFILL = ("1996-01-01", "1997-12-31")
SHORT_BACKFILL = ("1996-01-01", "1996-03-31")
CALENDAR = (f"{YEAR}-01-01", f"{YEAR}-12-31")


def _three(n: str) -> str:
    return f"lpad(({n})::VARCHAR, 3, '0')"


def _day_key(d: str) -> str:
    return f"(CASE WHEN {d} BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}' THEN strftime({d}, '%Y%m%d')::BIGINT ELSE -1::BIGINT END)"


def _key(*parts: str) -> str:
    return "sha256(" + " || '|' || ".join(parts) + ")"


def _bit(condition: str) -> str:
    return f"({condition})::INT::BIGINT"


def _lists(sepsis_hi: int = 12) -> str:
    rows = ", ".join(f"('{name}', '{kind}', '{prefix}', {m}, {a}, {sepsis_hi if name == 'sepsis_codes' else z}, '{ident}')" for name, kind, prefix, m, a, z, ident in LISTS)
    return f"""
  SELECT r.list_name, r.prefix || {_three('p_partkey % r.modulus')} AS code, p_name AS code_description, r.code_type, r.identifier
  FROM part JOIN (VALUES {rows}) r(list_name, code_type, prefix, modulus, low, high, identifier) ON p_partkey % r.modulus BETWEEN r.low AND r.high"""


_RAW_PATIENT = f"""
  SELECT o_orderkey::VARCHAR AS patient_id,
    CASE o_orderkey % 20 WHEN 0 THEN NULL WHEN 1 THEN '999' ELSE {_three('o_custkey % 50')} END AS drg,
    CASE o_orderkey % 97 WHEN 0 THEN '1997-13-45' ELSE strftime(o_orderdate::DATE - ((o_custkey * 97) % 36500)::INT, '%Y-%m-%d') END AS birth_date,
    strftime(o_orderdate::DATE, '%Y-%m-%d') AS admission_date, strftime(o_orderdate::DATE + (o_orderkey % 15)::INT, '%Y-%m-%d') AS discharge_date,
    CASE left(o_orderpriority, 1) WHEN '1' THEN 'Emergency' WHEN '2' THEN 'Urgent' WHEN '3' THEN 'Elective' WHEN '5' THEN 'ELECTIVE' END AS admission_type
  FROM orders"""
_RAW_DIAGNOSIS = f"""
  SELECT l_orderkey::VARCHAR AS patient_id, 'D' || {_three('l_partkey % 100')} AS diag_code, l_linenumber::BIGINT AS diag_rank_num,
    CASE WHEN l_returnflag IN ('A', 'N') THEN translate(l_returnflag, 'A', 'Y') END AS present_on_admission_ind
  FROM lineitem"""
_RAW_PROCEDURE = f"SELECT l_orderkey::VARCHAR AS patient_id, 'P' || {_three('l_suppkey % 10')} AS procedure_code FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL"


def _model(sepsis_hi: int = 12, p: str = "") -> str:
    """CTEs of the whole model; ``p`` prefixes those that depend on the code lists."""
    year = str(YEAR)
    diagnosis_kinds = {"bad_principal": "'SEPTI2D', 'INFECID', 'MDC14PRINDX', 'MDC15PRINDX'", "bad_present": "'SEPTI2D', 'INFECID'", "sepsis": "'SEPTI2D'"}
    marks = ", ".join(f"coalesce(bool_or(code_type = 'Diagnosis' AND identifier IN ({v})), false) AS {k}" for k, v in diagnosis_kinds.items())
    base = (
        f"raw_patient AS ({_RAW_PATIENT}),\nraw_diagnosis AS ({_RAW_DIAGNOSIS}),\nraw_procedure AS ({_RAW_PROCEDURE}),\n"
        """typed AS (SELECT patient_id::BIGINT AS patient_id, drg, try_cast(birth_date AS DATE) AS birth_date, admission_date::DATE AS admission_date,
    discharge_date::DATE AS discharge_date, admission_type FROM raw_patient),
"""
        if not p
        else ""
    )
    return base + f"""{p}lists AS ({_lists(sepsis_hi)}),
{p}entries AS (
  SELECT code, code_description, code_type, identifier, {year}::BIGINT AS reference_year, {_key('code', 'identifier', 'code_type', f"'{year}'")} AS code_identifier_sk FROM {p}lists
  UNION ALL
  SELECT 'UNKNOWN', 'UNKNOWN', kind, 'UNKNOWN', y::BIGINT, {_key('kind', "'UNKNOWN'", "'UNKNOWN'", 'y::VARCHAR')}
  FROM (SELECT unnest(['DRG', 'Diagnosis', 'Procedure', 'UNKNOWN']) AS kind), (SELECT unnest([{year}, -1]) AS y)
),
{p}codebook AS (
  SELECT code_type, code, {_key('code', 'code_type', f"'{year}'")} AS code_sk, min(code_description) AS code_description,
    array_to_string(list(DISTINCT identifier ORDER BY identifier), ',') AS names, {marks},
    coalesce(bool_or(code_type = 'DRG' AND identifier = 'SURGI2R'), false) AS surgical,
    coalesce(bool_or(code_type = 'Procedure' AND identifier = 'ORPROC'), false) AS operating_room
  FROM {p}entries WHERE reference_year = {year} GROUP BY ALL
),
{p}dx AS (
  SELECT patient_id::BIGINT AS patient_id, diag_code, diag_rank_num, coalesce(diag_rank_num = 1, false) AS first_line,
    coalesce(present_on_admission_ind = 'Y', false) AS present, present_on_admission_ind, b.code_sk, b.code_description, coalesce(b.names, '') AS names,
    coalesce(bad_principal, false) AS bad_principal, coalesce(bad_present, false) AS bad_present, coalesce(sepsis, false) AS sepsis
  FROM raw_diagnosis LEFT JOIN {p}codebook b ON b.code_type = 'Diagnosis' AND b.code = coalesce(diag_code, 'UNKNOWN')
),
{p}px AS (
  SELECT patient_id::BIGINT AS patient_id, procedure_code, b.code_sk, coalesce(b.names, '') AS names, coalesce(operating_room, false) AS operating_room
  FROM raw_procedure LEFT JOIN {p}codebook b ON b.code_type = 'Procedure' AND b.code = coalesce(procedure_code, 'UNKNOWN')
),
{p}marks AS (
  SELECT patient_id, bool_or(first_line AND bad_principal) AS out_principal, bool_or(NOT first_line AND present AND bad_present) AS out_present,
    bool_or(NOT first_line AND sepsis) AS hit, count_if(NOT first_line) AS n_secondary, count_if(first_line) AS n_first
  FROM {p}dx GROUP BY patient_id
),
{p}rooms AS (SELECT patient_id, bool_or(operating_room) AS operated, count(*) AS n_procedures FROM {p}px GROUP BY patient_id),
{p}visit AS (
  SELECT t.*, coalesce(t.drg, 'UNKNOWN') AS drg_text, strftime(t.discharge_date, '%Y-%m') AS year_month, b.code_sk AS drg_key, b.names AS drg_names, coalesce(b.surgical, false) AS surgical,
    coalesce(m.out_principal, false) AS out_principal, coalesce(m.out_present, false) AS out_present, coalesce(m.hit, false) AS hit, m.n_first,
    coalesce(m.n_secondary, 0)::BIGINT AS n_secondary, coalesce(r.operated, false) AS operated, coalesce(r.n_procedures, 0)::BIGINT AS n_procedures,
    coalesce(t.drg = '999', false) AS out_drg, lower(coalesce(t.admission_type, '')) = 'elective' AS elective, coalesce(year(t.admission_date) - year(t.birth_date) >= 18, false) AS adult
  FROM typed t LEFT JOIN {p}codebook b ON b.code_type = 'DRG' AND b.code = coalesce(t.drg, 'UNKNOWN') LEFT JOIN {p}marks m USING (patient_id) LEFT JOIN {p}rooms r USING (patient_id)
),
{p}included AS (SELECT * FROM {p}visit WHERE elective AND adult AND surgical AND operated AND drg_text <> '999'),
{p}cohort AS (SELECT * FROM {p}included WHERE NOT (out_principal OR out_present OR out_drg))"""


def sql(final: str, *, other_sepsis_hi: int | None = None) -> str:
    """The model and a final statement; ``other_sepsis_hi`` adds a second model prefixed ``b_`` with other code lists."""
    model = _model() + (",\n" + _model(other_sepsis_hi, "b_") if other_sepsis_hi else "")
    return f"WITH {model}\n{final}"


def _in(window: tuple[str, str]) -> str:
    return f"discharge_date BETWEEN DATE '{window[0]}' AND DATE '{window[1]}'"


def _metrics(window: tuple[str, str] = CALENDAR) -> str:
    return f"""(SELECT year_month AS month, count_if(hit)::BIGINT AS numerator, count(*)::BIGINT AS denominator,
  round(count_if(hit)::DECIMAL(38, 10) / count(*), 3)::DOUBLE AS rate FROM cohort WHERE {_in(window)} GROUP BY year_month)"""


def _spine(window: tuple[str, str]) -> str:
    return f"""(SELECT s.month, coalesce(m.numerator, 0)::BIGINT AS numerator, coalesce(m.denominator, 0)::BIGINT AS denominator, m.rate
  FROM (SELECT strftime(unnest(generate_series(TIMESTAMP '{window[0]}', TIMESTAMP '{window[1]}', INTERVAL 1 MONTH)), '%Y-%m') AS month) s
  LEFT JOIN {_metrics(window)} m USING (month))"""


def run_id(window: tuple[str, str], run_date: str | None = None) -> str:
    return f"psi13-{run_date or window[1]}-{window[0][:7]}-{window[1][:7]}"


def _published(window: tuple[str, str], name: str, version: str = "") -> str:
    return f"SELECT month AS year_month, numerator, denominator, rate, '{name}' AS run_id, TIMESTAMP '{window[1]} 00:00:00' AS computed_at{version} FROM {_spine(window)}"


def _audit(window: tuple[str, str], name: str, computed: str, p: str = "") -> str:
    """Numerator encounters of a window with the lowest (rank, code) qualifying line."""
    return f"""SELECT c.patient_id, any_value(c.discharge_date) AS discharge_date, any_value(c.year_month) AS year_month,
  first(d.diag_code ORDER BY d.diag_rank_num, d.diag_code) AS qualifying_sepsis_code, first(d.code_sk ORDER BY d.diag_rank_num, d.diag_code) AS qualifying_sepsis_code_sk,
  0::BIGINT AS is_principal_diag, {_bit('first(d.present ORDER BY d.diag_rank_num, d.diag_code)')} AS is_present_on_admission,
  '{YEAR}-01-01' AS ref_version, '{name}' AS run_id, TIMESTAMP '{computed} 00:00:00' AS computed_at
FROM {p}cohort c JOIN {p}dx d USING (patient_id) WHERE {_in(window)} AND c.hit AND d.sepsis AND NOT d.first_line GROUP BY c.patient_id"""


_DISCHARGE = f"""SELECT patient_id, coalesce(birth_date, DATE '1900-01-01') AS birth_date, {_day_key("coalesce(birth_date, DATE '1900-01-01')")} AS birth_date_sk,
  ((strftime(admission_date, '%Y%m%d')::BIGINT - strftime(birth_date, '%Y%m%d')::BIGINT) // 10000)::BIGINT AS age_at_admission, {_bit('adult')} AS is_adult,
  admission_date, {_day_key('admission_date')} AS admission_date_sk, coalesce(admission_type, 'UNKNOWN') AS admission_type, {_bit('elective')} AS is_elective,
  discharge_date, {_day_key('discharge_date')} AS discharge_date_sk, drg_text AS drg, coalesce(drg_key, {_key("'DRG'", "'UNKNOWN'", f"'{YEAR}'")}) AS drg_code_sk FROM visit"""
_DIAGNOSIS = f"""SELECT patient_id, coalesce(diag_code, 'UNKNOWN') AS diag_code, coalesce(code_sk, {_key("'Diagnosis'", "'UNKNOWN'", f"'{YEAR}'")}) AS diag_code_sk, diag_rank_num,
  CASE WHEN first_line THEN 'Principal' WHEN diag_rank_num > 1 THEN 'Secondary' ELSE 'UNKNOWN' END AS diag_type, {_bit('first_line')} AS is_principal_diag,
  coalesce(present_on_admission_ind, 'N') AS present_on_admission_ind, {_bit('present')} AS is_present_on_admission FROM dx"""
_PROCEDURE = f"SELECT patient_id, coalesce(procedure_code, 'UNKNOWN') AS procedure_code, coalesce(code_sk, {_key("'Procedure'", "'UNKNOWN'", f"'{YEAR}'")}) AS procedure_code_sk FROM px"
_DIM = f"SELECT {_key('code', 'code_type', 'reference_year::VARCHAR')} AS code_sk, code, code_type, min(code_description) AS code_description, reference_year FROM entries GROUP BY code, code_type, reference_year"
_BRIDGE = f"SELECT DISTINCT {_key('code', 'code_type', 'reference_year::VARCHAR')} AS code_sk, {_key('identifier', 'code_type', 'reference_year::VARCHAR')} AS identifier_sk, identifier, code_type, reference_year FROM entries"

_LINES = "ORDER BY diag_rank_num NULLS FIRST, diag_code, present, code_sk NULLS FIRST"
_FIRST_LINES = f"""(SELECT patient_id, first(code_sk {_LINES}) AS code_sk, first(diag_code {_LINES}) AS code, first(names {_LINES}) AS identifiers,
  first({_bit('present')} {_LINES}) AS is_present_on_admission FROM dx WHERE first_line GROUP BY patient_id)"""
_LATER_LINES = f"""(SELECT patient_id, row_number() OVER (PARTITION BY patient_id {_LINES})::BIGINT AS position, code_sk, diag_code AS code, names AS identifiers,
  {_bit('present')} AS is_present_on_admission FROM dx WHERE NOT first_line)"""
_PROCEDURES = "(SELECT patient_id, row_number() OVER (PARTITION BY patient_id ORDER BY procedure_code, code_sk NULLS FIRST)::BIGINT AS position, code_sk, procedure_code AS code, names AS identifiers FROM px)"


def _staged(corrected: str) -> str:
    """Newest staged row per encounter, where ``corrected`` tells whether its correction applies."""
    return f"""SELECT s.patient_id, CASE WHEN {corrected} THEN '999' ELSE s.drg END AS drg, s.birth_date, s.admission_date, s.discharge_date, s.admission_type,
  s.admission_date::TIMESTAMP + to_days((s.patient_id::BIGINT % 10 + CASE WHEN {corrected} THEN 20 ELSE 0 END)::INT) AS updated_at FROM raw_patient s"""


_CORRECTED_AT = "(s.admission_date::TIMESTAMP + to_days((s.patient_id::BIGINT % 10 + 20)::INT))"


def _check(check: str, subject: str, violations: str, source: str, passed: str | None = None) -> str:
    return f"""SELECT '{check}' AS "check", '{subject}' AS subject, v AS violations, {passed or 'v = 0'} AS passed FROM (SELECT coalesce({violations}, 0)::BIGINT AS v, count(*) AS n FROM {source})"""


def _all(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    def add(name: str, final: str, **options) -> None:
        q[name] = sql(final, **options)

    # sources, sinks, typed tables
    add("src_patient", "SELECT * FROM raw_patient")
    add("src_procedure", "SELECT * FROM raw_procedure")
    add("src_diagnosis", "SELECT * FROM raw_diagnosis")
    add("src_codes", "SELECT list_name, code, code_description, code_type, identifier FROM lists")
    add(
        "src_quarantine",
        """SELECT CASE patient_id::BIGINT % 50 WHEN 0 THEN 'header' WHEN 1 THEN 'tokens' WHEN 2 THEN 'cast' ELSE 'loaded' END AS reason, patient_id, diag_code,
  CASE patient_id::BIGINT % 50 WHEN 1 THEN NULL WHEN 2 THEN 'no ' || diag_rank_num ELSE diag_rank_num::VARCHAR END AS diag_rank_num FROM raw_diagnosis""",
    )
    add("sink_month_roundtrip", f"SELECT *, date_trunc('month', discharge_date)::DATE AS discharge_month FROM ({_DISCHARGE})")
    add("sink_year_roundtrip", "SELECT * FROM entries")
    add("sink_clustered_roundtrip", "SELECT * FROM entries")
    add("sink_rerun_idempotent", _DIAGNOSIS)
    add("sink_csv_roundtrip", f"SELECT * FROM {_metrics()}")
    add("core_patient", "SELECT * FROM typed")
    add("core_procedure", "SELECT patient_id::BIGINT AS patient_id, procedure_code FROM raw_procedure")
    add("core_diagnosis", "SELECT patient_id::BIGINT AS patient_id, diag_code, diag_rank_num, present_on_admission_ind FROM raw_diagnosis")
    add("safe_date_parse", "SELECT patient_id::BIGINT AS patient_id, birth_date AS birth_date_text, try_cast(birth_date AS DATE) AS birth_date FROM raw_patient")
    add("age_at_admission", f"SELECT patient_id, age_at_admission FROM ({_DISCHARGE})")
    add(
        "adult_flag",
        f"SELECT patient_id, {_bit('adult')} AS is_adult, {_bit('coalesce(birth_date + INTERVAL 18 YEAR <= admission_date, false)')} AS is_adult_strict FROM visit",
    )
    add("elective_flag", f"SELECT patient_id, admission_type, is_elective FROM ({_DISCHARGE})")
    add("diag_type", f"SELECT patient_id, diag_code, diag_rank_num, diag_type, is_principal_diag FROM ({_DIAGNOSIS})")

    # reference layer
    add("code_map", f"SELECT * FROM entries WHERE reference_year = {YEAR} AND code <> 'UNKNOWN'")
    add("unknown_members", "SELECT * FROM entries")
    add("dim_code", _DIM)
    add("bridge", _BRIDGE)
    add(
        "dim_date",
        f"""SELECT {_day_key('d')} AS date_sk, d AS full_date, year(d)::BIGINT AS "year", month(d)::BIGINT AS "month", strftime(d, '%Y-%m') AS year_month, date_trunc('month', d)::DATE AS month_start_date
FROM (SELECT unnest(generate_series(least(min(birth_date), DATE '1900-01-01')::TIMESTAMP, max(discharge_date)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM typed)
UNION ALL SELECT -1, DATE '1800-01-01', -1, -1, '1800-01', DATE '1800-01-01'""",
    )
    add("code_identifiers", f"SELECT code_sk, code_type, {YEAR}::BIGINT AS reference_year, names AS identifiers FROM codebook")
    add("numerator_codes", "SELECT code_sk FROM codebook WHERE sepsis")

    # facts and joins
    add("fct_discharge", _DISCHARGE)
    add("fct_diagnosis", _DIAGNOSIS)
    add("fct_procedure", _PROCEDURE)
    add(
        "date_roles",
        f"""SELECT patient_id, birth_date_sk, year(birth_date)::BIGINT AS birth_year, admission_date_sk, strftime(admission_date, '%Y-%m') AS admission_year_month, discharge_date_sk,
  date_trunc('month', discharge_date)::DATE AS discharge_month_start_date FROM ({_DISCHARGE})""",
    )
    add("code_lookup_left", "SELECT patient_id, coalesce(diag_code, 'UNKNOWN') AS diag_code, diag_rank_num, code_sk, code_description FROM dx")
    add("orphan_children", f"SELECT patient_id, coalesce(diag_code, 'UNKNOWN') AS diag_code, diag_rank_num, {_bit('patient_id % 7 <> 0 AND patient_id IN (SELECT patient_id FROM typed)')} AS has_parent FROM dx")
    add("semi_surgical", "SELECT patient_id, drg_text AS drg, drg_key AS drg_code_sk FROM visit WHERE surgical")
    add("semi_or_procedure", "SELECT patient_id FROM visit WHERE operated")
    add("ungroupable_drg", "SELECT patient_id, drg FROM typed WHERE coalesce(drg, '999') = '999'")

    # cohorts and the indicator
    add("denominator_inclusions", f"SELECT patient_id, year_month FROM included WHERE {_in(CALENDAR)}")
    add("denominator_exclusions", "SELECT patient_id FROM visit WHERE out_principal OR out_present OR out_drg")
    add("eligible", f"SELECT patient_id, year_month FROM cohort WHERE {_in(CALENDAR)}")
    add("monthly_metrics", f"SELECT * FROM {_metrics()} ORDER BY month")
    reasons = {"principal_diagnosis": "out_principal", "secondary_present_on_admission": "out_present", "ungroupable_drg": "out_drg", "none": "NOT (out_principal OR out_present OR out_drg)"}
    add("exclusion_reasons", _all(*[f"SELECT year_month, '{r}' AS reason, count(*)::BIGINT AS encounters FROM included WHERE {_in(CALENDAR)} AND {c} GROUP BY year_month" for r, c in reasons.items()]))

    # a third of the rows of each table at one encounter
    def hot(text: str) -> str:
        for raw, where, to in ((_RAW_DIAGNOSIS, "patient_id::BIGINT % 3 = 0", "3"), (_RAW_PROCEDURE, "patient_id::BIGINT % 3 = 1", "4"), (_RAW_PATIENT, "patient_id::BIGINT % 3 = 2 AND coalesce(drg, '') <> '999'", "5")):
            text = text.replace(raw, f"SELECT * REPLACE (CASE WHEN {where} THEN '{to}' ELSE patient_id END AS patient_id) FROM ({raw})")
        return text

    left_in = "patient_id NOT IN (SELECT patient_id FROM visit WHERE out_principal OR out_present OR out_drg)"
    q["hot_encounter_metrics"] = hot(sql(f"""SELECT year_month AS month, count(DISTINCT patient_id) FILTER (WHERE hit)::BIGINT AS numerator, count(DISTINCT patient_id)::BIGINT AS denominator,
  round((count(DISTINCT patient_id) FILTER (WHERE hit))::DECIMAL(38, 10) / count(DISTINCT patient_id), 3)::DOUBLE AS rate FROM included WHERE {_in(CALENDAR)} AND {left_in} GROUP BY year_month"""))
    out_of = {"principal_diagnosis": "out_principal", "secondary_present_on_admission": "out_present", "ungroupable_drg": "patient_id IN (SELECT patient_id FROM visit WHERE out_drg)", "none": left_in}
    q["hot_encounter_reasons"] = hot(sql(_all(*[f"SELECT year_month, '{r}' AS reason, count(DISTINCT patient_id)::BIGINT AS encounters FROM included WHERE {_in(CALENDAR)} AND {c} GROUP BY year_month" for r, c in out_of.items()])))
    q["hot_encounter_arrays"] = hot(sql(f"""SELECT v.patient_id, v.discharge_date, f.code AS principal_code, f.is_present_on_admission AS principal_poa, v.n_secondary,
  sha256(coalesce(s.codes, '')) AS secondary_sha256, v.n_procedures, sha256(coalesce(o.codes, '')) AS procedures_sha256 FROM visit v LEFT JOIN {_FIRST_LINES} f USING (patient_id)
LEFT JOIN (SELECT patient_id, string_agg(code, ',' ORDER BY position) AS codes FROM {_LATER_LINES} GROUP BY patient_id) s USING (patient_id)
LEFT JOIN (SELECT patient_id, string_agg(code, ',' ORDER BY position) AS codes FROM {_PROCEDURES} GROUP BY patient_id) o USING (patient_id)"""))

    # nested summary
    add(
        "discharge_summary_flat",
        f"""SELECT d.patient_id, d.birth_date, d.birth_date_sk, d.age_at_admission, d.is_adult, d.admission_date, d.admission_date_sk, d.admission_type, d.is_elective,
  d.discharge_date, d.discharge_date_sk, d.drg, coalesce(v.drg_key, 'Unknown') AS drg_code_sk, coalesce(v.drg_names, '') AS drg_identifiers,
  f.code AS principal_code, f.code_sk AS principal_code_sk, f.identifiers AS principal_identifiers, f.is_present_on_admission AS principal_poa,
  coalesce(s.codes, '') AS secondary_codes, v.n_secondary, coalesce(o.codes, '') AS procedure_codes, v.n_procedures
FROM ({_DISCHARGE}) d JOIN visit v USING (patient_id) LEFT JOIN {_FIRST_LINES} f USING (patient_id)
LEFT JOIN (SELECT patient_id, string_agg(code, ',' ORDER BY position) AS codes FROM {_LATER_LINES} GROUP BY patient_id) s USING (patient_id)
LEFT JOIN (SELECT patient_id, string_agg(code, ',' ORDER BY position) AS codes FROM {_PROCEDURES} GROUP BY patient_id) o USING (patient_id)""",
    )
    add("principal_diagnosis", f"SELECT m.patient_id, f.code_sk, f.code, f.identifiers, f.is_present_on_admission FROM marks m LEFT JOIN {_FIRST_LINES} f USING (patient_id)")
    add("secondary_diagnoses", f"SELECT * FROM {_LATER_LINES}")
    add("procedures_array", f"SELECT * FROM {_PROCEDURES}")

    # rolling, incremental, audit
    add("rolling_12m", f"SELECT * FROM {_metrics(ROLLING)} ORDER BY month")
    add("rolling_12m_spine", f"SELECT * FROM {_spine(ROLLING)} ORDER BY month")
    add("backfill_range", f"SELECT * FROM {_spine(BACKFILL)} ORDER BY month")
    lookback = "TIMESTAMP '1997-12-08 00:00:00'"
    add("lookback_extract", f"SELECT * FROM ({_staged('false')}) WHERE updated_at >= {lookback} UNION ALL SELECT * FROM ({_staged('true')}) WHERE patient_id::BIGINT % 5 = 0 AND updated_at >= {lookback}")
    add("upsert_latest", _staged(f"(s.patient_id::BIGINT % 5 = 0 AND {_CORRECTED_AT} >= {lookback})"))
    q["upsert_touched"] = q["upsert_latest"]
    late = f"(SELECT s.patient_id::BIGINT FROM raw_patient s WHERE s.patient_id::BIGINT % 5 = 0 AND {_CORRECTED_AT} >= {lookback})"
    add("upsert_fct_diagnosis", f"SELECT * FROM ({_DIAGNOSIS}) WHERE diag_rank_num <= 3 OR patient_id NOT IN {late}")
    add("upsert_fct_procedure", f"SELECT * FROM ({_PROCEDURE}) WHERE procedure_code <> 'P009' OR patient_id NOT IN {late}")
    add("stream_staged_upsert", _staged("(s.patient_id::BIGINT % 5 = 0)"))
    add("metrics_upsert", _published(ROLLING, f"psi13-{ROLLING[1]}", f", '{YEAR}-01-01' AS ref_version"))
    add("numerator_patients", _audit(CALENDAR, "psi13-1997-12-15", "1997-12-15"))
    add(
        "numerator_diff",
        f"""SELECT patient_id, year_month, CASE WHEN a.patient_id IS NULL THEN 'added' WHEN b.patient_id IS NULL THEN 'removed' ELSE 'kept' END AS change
FROM (SELECT patient_id, year_month FROM cohort WHERE hit AND {_in(CALENDAR)}) a FULL JOIN (SELECT patient_id, year_month FROM b_cohort WHERE hit AND {_in(CALENDAR)}) b USING (patient_id, year_month)""",
        other_sepsis_hi=14,
    )
    add(
        "run_log",
        f"""SELECT 'psi13-1997-12-15' AS run_id, DATE '1997-12-15' AS execution_date, DATE '{CALENDAR[0]}' AS window_start, DATE '{CALENDAR[1]}' AS window_end, '{YEAR}-01-01' AS ref_version,
  coalesce(sum(numerator), 0)::BIGINT AS numerator, coalesce(sum(denominator), 0)::BIGINT AS denominator, count(*)::BIGINT AS months,
  CASE WHEN count(*) = 12 AND count_if(numerator > denominator) = 0 THEN 'PASSED' ELSE 'FAILED' END AS dq_status, 'SUCCEEDED' AS pipeline_status FROM {_metrics()}""",
    )
    low, high = VERSION_YEARS
    listed = "EXISTS (SELECT 1 FROM part WHERE p_partkey % 100 = substr(d.diag_code, 2)::INT)"
    add(
        "effective_dated_lookup",
        f"""SELECT patient_id, coalesce(d.diag_code, 'UNKNOWN') AS diag_code, d.diag_rank_num,
  CASE WHEN year(v.discharge_date) BETWEEN {low} AND {high} THEN year(v.discharge_date) || '-01-01' END AS ref_version,
  {_bit(f"coalesce(year(v.discharge_date) BETWEEN {low} AND {high} AND substr(d.diag_code, 2)::INT BETWEEN 5 AND 12 + year(v.discharge_date) - {YEAR} AND {listed}, false)")} AS is_sepsis_code
FROM dx d LEFT JOIN visit v USING (patient_id)""",
    )

    ranges = f"""(SELECT 'D' || {_three('k')} AS diag_code, s, CASE WHEN j < 5 OR k % 4 > 0 THEN s + (60 + (k * 31 + j * 211) % 600)::INT END AS e, 'r-' || k || '-' || j AS range_name
  FROM (SELECT k, j, DATE '1995-01-01' + (j * 400 + (k * 13 + j * 97) % 300)::INT AS s FROM (SELECT DISTINCT p_partkey % 100 AS k FROM part), (SELECT unnest(range(6)) AS j)))"""
    add(
        "interval_lookup",
        f"""SELECT any_value(patient_id) AS patient_id, any_value(d.diag_code) AS diag_code, any_value(d.diag_rank_num) AS diag_rank_num, any_value(d.discharge_date) AS discharge_date, arg_max(r.range_name, r.s) AS range_name
FROM (SELECT row_number() OVER () AS line, dx.patient_id, dx.diag_code, dx.diag_rank_num, v.discharge_date FROM dx LEFT JOIN visit v USING (patient_id)) d
LEFT JOIN {ranges} r ON r.diag_code = d.diag_code AND d.discharge_date >= r.s AND (r.e IS NULL OR d.discharge_date <= r.e) GROUP BY line""",
    )
    add(
        "dq_range_overlap",
        f"""SELECT 'range_overlap' AS "check", 'diag_code' AS subject, count(*)::BIGINT AS violations, count(*) = 0 AS passed FROM {ranges} a
WHERE EXISTS (SELECT 1 FROM {ranges} b WHERE b.diag_code = a.diag_code AND b.s < a.s AND (b.e IS NULL OR b.e >= a.s))""",
    )

    # facts keyed by the version effective on the discharge
    years = f"(SELECT unnest(range({low}, {high + 1})) AS y)"
    moving = "CASE WHEN r.list_name = 'sepsis_codes' THEN r.high + y - 1997 ELSE r.high END"
    vlists = _lists().replace("BETWEEN r.low AND r.high", f"BETWEEN r.low AND {moving}").replace("FROM part JOIN", f"FROM part CROSS JOIN {years} JOIN").replace("SELECT r.list_name,", "SELECT y, r.list_name,")
    vbook = f"""vbook AS (SELECT y, code_type, code, {_key('code', 'code_type', 'y::VARCHAR')} AS code_sk, array_to_string(list(DISTINCT identifier ORDER BY identifier), ',') AS names
  FROM (SELECT y, code_type, code, identifier FROM ({vlists}) UNION ALL SELECT y, kind, 'UNKNOWN', 'UNKNOWN' FROM {years}, (SELECT unnest(['DRG', 'Diagnosis', 'Procedure']) AS kind)) GROUP BY ALL),
when_out AS (SELECT patient_id, CASE WHEN year(max(discharge_date)) BETWEEN {low} AND {high} THEN year(max(discharge_date)) END AS y FROM typed GROUP BY patient_id)"""

    def versioned(final: str) -> str:
        return f"WITH {_model()},\n{vbook}\n{final}"

    def keyed(fact: str, kind: str, code: str, key: str) -> str:
        return f"""SELECT f.* REPLACE (coalesce(b.code_sk, {_key(f"'{kind}'", "'UNKNOWN'", "coalesce(w.y, -1)::VARCHAR")}) AS {key}), w.y || '-01-01' AS ref_version, w.y::BIGINT AS reference_year
FROM ({fact}) f LEFT JOIN when_out w USING (patient_id) LEFT JOIN vbook b ON b.y = w.y AND b.code_type = '{kind}' AND b.code = f.{code}"""

    q["fct_discharge_versioned"] = versioned(keyed(_DISCHARGE, "DRG", "drg", "drg_code_sk"))
    q["fct_diagnosis_versioned"] = versioned(keyed(_DIAGNOSIS, "Diagnosis", "diag_code", "diag_code_sk"))
    q["fct_procedure_versioned"] = versioned(keyed(_PROCEDURE, "Procedure", "procedure_code", "procedure_code_sk"))
    # the summary's SQL on codebook entries of the discharge's own year
    own = "JOIN when_out w USING (patient_id) LEFT JOIN vbook b ON b.y = w.y AND b.code_type = '{kind}' AND b.code = {code}"
    line = "diag_rank_num NULLS FIRST, diag_code, present, code_sk NULLS FIRST"
    q["discharge_summary_versioned"] = versioned(f""", vdx AS (SELECT x.* REPLACE (b.code_sk AS code_sk, coalesce(b.names, '') AS names) FROM dx x {own.format(kind='Diagnosis', code="coalesce(x.diag_code, 'UNKNOWN')")}),
vpx AS (SELECT x.* REPLACE (b.code_sk AS code_sk, coalesce(b.names, '') AS names) FROM px x {own.format(kind='Procedure', code="coalesce(x.procedure_code, 'UNKNOWN')")})
SELECT d.* REPLACE (coalesce(b.code_sk, 'Unknown') AS drg_code_sk), coalesce(b.names, '') AS drg_identifiers, f.code AS principal_code, f.code_sk AS principal_code_sk, f.names AS principal_identifiers,
  f.poa AS principal_poa, coalesce(s.codes, '') AS secondary_codes, coalesce(s.n, 0)::BIGINT AS n_secondary, coalesce(o.codes, '') AS procedure_codes, coalesce(o.n, 0)::BIGINT AS n_procedures
FROM ({_DISCHARGE}) d {own.format(kind='DRG', code='d.drg')}
LEFT JOIN (SELECT patient_id, first(diag_code ORDER BY {line}) AS code, first(code_sk ORDER BY {line}) AS code_sk, first(names ORDER BY {line}) AS names, first({_bit('present')} ORDER BY {line}) AS poa
  FROM vdx WHERE first_line GROUP BY patient_id) f USING (patient_id)
LEFT JOIN (SELECT patient_id, count(*) AS n, string_agg(diag_code, ',' ORDER BY {line}) AS codes FROM vdx WHERE NOT first_line GROUP BY patient_id) s USING (patient_id)
LEFT JOIN (SELECT patient_id, count(*) AS n, string_agg(procedure_code, ',' ORDER BY procedure_code) AS codes FROM vpx GROUP BY patient_id) o USING (patient_id)""")

    # each discharge under the lists of its own year: only the sepsis range moves
    marked = f"""SELECT dx.*, substr(diag_code, 2)::INT AS k, year(discharge_date) AS y, k BETWEEN 5 AND 12 + y - {YEAR} AS septic
    FROM dx JOIN typed USING (patient_id) WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey % 100 = substr(dx.diag_code, 2)::INT)"""
    by_version = f"""WITH {_model()},
  lines AS ({marked}),
  found AS (SELECT patient_id, bool_or(CASE WHEN first_line THEN septic OR k <= 7 OR k BETWEEN 20 AND 34 ELSE present AND (septic OR k <= 7) END) AS barred,
    min((diag_rank_num, diag_code, present, {_key('diag_code', "'Diagnosis'", 'y::VARCHAR')})) FILTER (NOT first_line AND septic) AS line FROM lines GROUP BY patient_id),
  kept AS (SELECT i.patient_id, i.discharge_date, i.year_month, year(i.discharge_date) || '-01-01' AS ref_version, f.line FROM included i LEFT JOIN found f USING (patient_id)
    WHERE NOT i.out_drg AND NOT coalesce(f.barred, false) AND year(i.discharge_date) BETWEEN {low} AND {high})
"""

    def counted(window: tuple[str, str]) -> str:
        return f"""(SELECT year_month AS month, count(line)::BIGINT AS numerator, count(*)::BIGINT AS denominator,
  round(count(line)::DECIMAL(38, 10) / count(*), 3)::DOUBLE AS rate, max(ref_version) AS ref_version FROM kept WHERE {_in(window)} GROUP BY year_month)"""

    def found_rows(window: tuple[str, str], name: str) -> str:
        return f"""SELECT patient_id, discharge_date, year_month, line[2] AS qualifying_sepsis_code, line[4] AS qualifying_sepsis_code_sk, 0::BIGINT AS is_principal_diag,
  line[3]::INT::BIGINT AS is_present_on_admission, ref_version, '{name}' AS run_id, TIMESTAMP '{window[1]} 00:00:00' AS computed_at FROM kept WHERE line IS NOT NULL AND {_in(window)}"""

    def logged(window: tuple[str, str]) -> str:
        return f"""SELECT '{run_id(window)}' AS run_id, DATE '{window[1]}' AS execution_date, DATE '{window[0]}' AS window_start, DATE '{window[1]}' AS window_end, '{window[1][:4]}-01-01' AS ref_version,
  coalesce(sum(numerator), 0)::BIGINT AS numerator, coalesce(sum(denominator), 0)::BIGINT AS denominator, count(*)::BIGINT AS months,
  CASE WHEN count_if(numerator > denominator) = 0 AND (SELECT count(*) FROM {counted(window)} later JOIN {counted(window)} earlier
    ON later.month = strftime((earlier.month || '-01')::DATE + INTERVAL 1 MONTH, '%Y-%m') WHERE abs(later.rate - earlier.rate) > 0.1) = 0 THEN 'PASSED' ELSE 'FAILED' END AS dq_status,
  'SUCCEEDED' AS pipeline_status FROM {counted(window)}"""

    q["monthly_metrics_versioned"] = by_version + f"SELECT * FROM {counted(ROLLING)}"
    q["numerator_patients_versioned"] = by_version + found_rows(ROLLING, f"psi13-{ROLLING[1]}")
    q["nightly_metrics"] = by_version + f"""SELECT s.month AS year_month, coalesce(m.numerator, 0)::BIGINT AS numerator, coalesce(m.denominator, 0)::BIGINT AS denominator, m.rate,
  '{run_id(ROLLING)}' AS run_id, TIMESTAMP '{ROLLING[1]} 00:00:00' AS computed_at, left(s.month, 4) || '-01-01' AS ref_version FROM {_spine(ROLLING)} s LEFT JOIN {counted(ROLLING)} m USING (month)"""
    q["nightly_current"] = q["nightly_metrics"]
    # corrections since 24 May 1997 restate the DRG, cut diagnoses after rank 3 and one procedure
    late = f"(SELECT s.patient_id FROM raw_patient s WHERE s.patient_id::BIGINT % 5 = 0 AND {_CORRECTED_AT} >= TIMESTAMP '1997-05-24 00:00:00')"
    restated = f"""typed AS (SELECT patient_id::BIGINT AS patient_id, CASE WHEN patient_id IN {late} THEN '999' ELSE drg END AS drg,"""
    q["nightly_from_extract"] = (
        q["nightly_metrics"]
        .replace("typed AS (SELECT patient_id::BIGINT AS patient_id, drg,", restated)
        .replace("FROM raw_diagnosis LEFT JOIN", f"FROM (SELECT * FROM raw_diagnosis WHERE diag_rank_num <= 3 OR patient_id NOT IN {late}) LEFT JOIN")
        .replace("FROM raw_procedure LEFT JOIN", f"FROM (SELECT * FROM raw_procedure WHERE procedure_code <> 'P009' OR patient_id NOT IN {late}) LEFT JOIN")
    )
    q["nightly_numerator_audit"] = by_version + _all(*[found_rows(w, run_id(w)) for w in (ROLLING_PREV, ROLLING)])
    q["nightly_run_log"] = by_version + _all(logged(ROLLING_PREV), logged(ROLLING))
    q["nightly_compacted"] = q["nightly_from_extract"]
    q["run_log_observed"] = f"SELECT run_id, numerator, denominator, months, dq_status, true AS timed FROM ({q['nightly_run_log']})"

    def checked(window: tuple[str, str]) -> str:
        moved = f"(SELECT count(*) FROM {counted(window)} later JOIN {counted(window)} earlier ON later.month = strftime((earlier.month || '-01')::DATE + INTERVAL 1 MONTH, '%Y-%m') WHERE abs(later.rate - earlier.rate) > 0.1)"
        rows = [("metric_bounds", "numerator<=denominator", f"(SELECT count_if(numerator > denominator) FROM {counted(window)})"), ("metric_bounds", "months=12", f"(SELECT abs(count(DISTINCT month) - 12) FROM {_spine(window)})"),
                ("mom_change", "abs(rate change)<=0.1", moved), ("reference_freshness", f"active_version_year>={window[1][:4]}", f"(SELECT (count(*) = 0)::INT FROM part WHERE {window[1][:4]} BETWEEN {low} AND {high})")]
        return _all(*[f"SELECT '{run_id(window)}' AS run_id, '{c}' AS \"check\", '{n}' AS subject, v::BIGINT AS violations, v = 0 AS passed FROM (SELECT {x} AS v)" for c, n, x in rows])

    q["nightly_checks"] = by_version + _all(checked(ROLLING_PREV), checked(ROLLING))
    q["nightly_backfill"] = by_version + _all(
        *[
            f"SELECT '{name}' AS run_id, year_month, count(*)::BIGINT AS encounters FROM kept WHERE line IS NOT NULL AND {_in(window)} GROUP BY year_month"
            for window, name in ((ROLLING, run_id(ROLLING)), (SHORT_BACKFILL, run_id(SHORT_BACKFILL, ROLLING[1])))
        ]
    )

    # data quality
    tables = {"raw_patient": "raw_patient", "raw_diagnosis": "raw_diagnosis", "raw_procedure": "raw_procedure", "code_map": "entries", "dim_code": "codebook", "bridge": "entries", "fct_discharge": "visit", "fct_diagnosis": "dx", "fct_procedure": "px"}
    add("dq_row_counts", _all(*[_check("row_count_nonzero", n, "(count(*) = 0)::INT", t) for n, t in tables.items()]))
    keys = {
        "fct_discharge(patient_id)": ("visit", "patient_id"),
        "fct_diagnosis(patient_id,diag_code_sk)": (f"({_DIAGNOSIS})", "(patient_id, diag_code_sk)"),
        "fct_procedure(patient_id,procedure_code)": ("px", "(patient_id, procedure_code)"),
        "core_diagnosis(patient_id,diag_code)": ("raw_diagnosis", "(patient_id, diag_code)"),
        "code_map(code_identifier_sk)": ("entries", "code_identifier_sk"),
        "dim_code(code_sk)": (f"({_DIM})", "code_sk"),
        "bridge(code_sk,identifier_sk,reference_year)": (f"({_BRIDGE})", "(code_sk, identifier_sk, reference_year)"),
    }
    add("dq_pk_unique", _all(*[_check("pk_unique", n, f"count(*) - count(DISTINCT {k})", t) for n, (t, k) in keys.items()]))
    in_span = lambda d: f"count_if(NOT {d} BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}')"
    orphans = [("fct_discharge.drg_code_sk", "count_if(drg_key IS NULL)", "visit"), ("fct_diagnosis.diag_code_sk", "count_if(code_sk IS NULL)", "dx"), ("fct_procedure.procedure_code_sk", "count_if(code_sk IS NULL)", "px")]
    orphans += [(f"fct_discharge.{c}_sk", in_span(f"coalesce({c}, DATE '1900-01-01')"), "visit") for c in ("birth_date", "admission_date", "discharge_date")]
    orphans += [(f"{f}.patient_id", "count_if(patient_id NOT IN (SELECT patient_id FROM typed))", t) for f, t in (("fct_diagnosis", "dx"), ("fct_procedure", "px"))]
    add("dq_fk_orphans", _all(*[_check("fk_resolves", n, v, t) for n, v, t in orphans]))
    shares = [("fct_discharge.drg", "drg IS NULL", "visit"), ("fct_discharge.admission_type", "admission_type IS NULL", "visit"), ("fct_diagnosis.diag_code", "diag_code IS NULL", "dx"), ("fct_procedure.procedure_code", "procedure_code IS NULL", "px")]
    add("dq_unknown_share", _all(*[_check("unknown_share", n, f"count_if({c})", t, "v <= 0.05 * n") for n, c, t in shares]))
    add(
        "dq_principal",
        _all(_check("principal_diagnosis", "principal_count_not_one", "count_if(n_first <> 1)", "marks"), _check("principal_diagnosis", "encounters_without_diagnoses", "count_if(n_first IS NULL)", "visit")),
    )
    add(
        "dq_dates",
        _all(_check("date_order", "birth_date<=admission_date", "count_if(birth_date > admission_date)", "typed"), _check("date_order", "admission_date<=discharge_date", "count_if(admission_date > discharge_date)", "typed")),
    )
    nulls = [(f"core_patient.{c}", c, "typed") for c in ("birth_date", "admission_date", "discharge_date", "drg", "admission_type")]
    nulls += [("fct_discharge.age_at_admission", "age_at_admission", f"({_DISCHARGE})"), ("fct_diagnosis.diag_rank_num", "diag_rank_num", "dx")]
    add("dq_nulls", _all(*[_check("not_null", n, f"count_if({c} IS NULL)", t) for n, c, t in nulls]))
    add(
        "dq_parse",
        _all(
            *[_check("parses", f"raw_patient.{c}", f"count_if({c} IS NOT NULL AND (try_cast({c} AS DATE) IS NULL OR NOT regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')))", "raw_patient") for c in ("birth_date", "admission_date", "discharge_date")],
            *[_check("parses", f"{t}.patient_id", "count_if(patient_id IS NOT NULL AND try_cast(patient_id AS BIGINT) IS NULL)", t) for t in ("raw_patient", "raw_diagnosis", "raw_procedure")],
        ),
    )
    add("dq_metric_bounds", _all(_check("metric_bounds", "numerator<=denominator", "count_if(numerator > denominator)", _metrics()), _check("metric_bounds", "months=12", "abs(count(*) - 12)", _metrics())))
    add(
        "dq_mom_change",
        _check("mom_change", "abs(rate change)<=0.1", "count_if(abs(later.rate - earlier.rate) > 0.1)", f"{_metrics()} later JOIN {_metrics()} earlier ON later.month = strftime((earlier.month || '-01')::DATE + INTERVAL 1 MONTH, '%Y-%m')"),
    )
    add("dq_freshness", "SELECT 'reference_freshness' AS \"check\", 'active_version_year>=1998' AS subject, (count(*) > 0)::INT::BIGINT AS violations, count(*) = 0 AS passed FROM part")
    add(
        "dq_reconcile",
        _all(
            _check("reconcile", "summary_rows=discharge_rows", "abs(count(*) - (SELECT count(*) FROM raw_patient))", "visit"),
            _check("reconcile", "secondary_diagnoses_size", f"sum(abs(v.n_secondary - coalesce(s.n, 0)))", f"visit v LEFT JOIN (SELECT patient_id, count(*) AS n FROM {_LATER_LINES} GROUP BY patient_id) s USING (patient_id)"),
            _check("reconcile", "procedures_size", f"sum(abs(v.n_procedures - coalesce(s.n, 0)))", f"visit v LEFT JOIN (SELECT patient_id, count(*) AS n FROM {_PROCEDURES} GROUP BY patient_id) s USING (patient_id)"),
        ),
    )
    contents = {
        "principal_diagnosis": f"(SELECT count(*) FROM marks m LEFT JOIN {_FIRST_LINES} f USING (patient_id) WHERE (m.n_first > 0) <> (f.code IS NOT NULL))",
        "procedures": f"(SELECT count(*) FROM (SELECT patient_id, list(procedure_code ORDER BY procedure_code) AS l FROM px GROUP BY patient_id) a JOIN (SELECT patient_id, list(code ORDER BY position) AS l FROM {_PROCEDURES} GROUP BY patient_id) b USING (patient_id) WHERE a.l <> b.l)",
        "secondary_diagnoses": f"(SELECT count(*) FROM (SELECT patient_id, list((diag_code, present) ORDER BY diag_code, present) AS l FROM dx WHERE NOT first_line GROUP BY patient_id) a JOIN (SELECT patient_id, list((code, is_present_on_admission = 1) ORDER BY code, is_present_on_admission) AS l FROM {_LATER_LINES} GROUP BY patient_id) b USING (patient_id) WHERE a.l <> b.l)",
    }
    add("dq_reconcile_contents", _all(*[f"SELECT 'reconcile_contents' AS \"check\", '{n}' AS subject, v::BIGINT AS violations, v = 0 AS passed FROM (SELECT {c} AS v)" for n, c in contents.items()]))
    again = {"code_map": "entries", "dim_code": f"({_DIM})", "bridge": f"({_BRIDGE})", "fct_discharge": f"({_DISCHARGE})", "fct_diagnosis": f"({_DIAGNOSIS})", "fct_procedure": f"({_PROCEDURE})", "discharge_summary": "visit", "monthly_metrics": _metrics()}
    add("dq_rerun", _all(*[f"SELECT 'rerun' AS \"check\", '{n}' AS subject, v::BIGINT AS violations, v = 0 AS passed FROM (SELECT (SELECT count(*) FROM ((FROM {t}) EXCEPT ALL (FROM {t}))) AS v)" for n, t in again.items()]))
    return q
