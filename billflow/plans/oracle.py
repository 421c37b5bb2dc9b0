"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code: correlated EXISTS / NOT IN / date
arithmetic instead of the joins the Spark plans use, so a shared mistake is
unlikely. Tables ``orders``, ``customer``, … are views the checker registers.
"""

from __future__ import annotations

from billflow.plans.bindings import ASOF, RULES
from billflow.schema import EXC_AWAITING, EXC_NO_PROVIDER, INVOICE_NOTE_PREFIX, NO_DX_LABEL


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


RULES_CTE = "r(rule_name, value) AS (VALUES " + ", ".join(
    f"({_q(k)}, {_q(v)})" for k, vals in RULES.items() for v in vals) + ")"

ASOF_SQL = f"DATE '{ASOF.isoformat()}'"

W_CTE = """w AS (
  SELECT o_orderkey AS item_id,
    CASE WHEN o_custkey % 17 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS client_id,
    CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No' END AS is_billed,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Kept' WHEN '2-HIGH' THEN 'Late Cancel'
      WHEN '3-MEDIUM' THEN 'No Show' WHEN '5-LOW' THEN 'Canceled' END AS status,
    CASE WHEN o_orderkey % 11 <> 0 THEN concat(CASE o_orderkey % 4 WHEN 0 THEN '993'
      WHEN 1 THEN '90837' WHEN 2 THEN '90791' ELSE '999' END, ': svc') END AS service_type,
    concat(strftime(DATE '2026-11-20' + CAST(o_orderkey % 14 AS INTEGER), '%m/%d/%Y'),
      ', 10:00 AM ET') AS date_time,
    CASE WHEN o_custkey % 10 = 0 THEN 'Staff 0 (Inactive)'
      WHEN o_custkey % 13 <> 0 THEN concat('Staff ', CAST(o_custkey % 7 AS VARCHAR)) END AS staff
  FROM orders)"""

C_CTE = """c AS (
  SELECT CASE WHEN c_custkey <> 0 THEN CAST(c_custkey AS VARCHAR) END AS client_id,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'United Healthcare NY' WHEN 'MACHINERY' THEN 'UnitedHealthcare'
      WHEN 'FURNITURE' THEN 'Self Pay' WHEN 'HOUSEHOLD' THEN 'Plan B' END AS payor,
    0 AS position
  FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), 'Plan Z', 1 FROM customer WHERE c_custkey % 3 = 0 AND c_custkey <> 0)"""

W_COLS = "item_id, client_id, is_billed, status, service_type, date_time, staff"


def rule_of(status_expr: str) -> str:
    return (f"CASE {status_expr} WHEN 'No Show' THEN 'no_show_cpts' WHEN 'Late Cancel' "
            f"THEN 'late_cancel_cpts' WHEN 'Kept' THEN 'kept_cpts' END")


def code_match(alias: str) -> str:
    """Service code allowed for the row's own status (anchored 'code:' prefix)."""
    rn = rule_of(f"{alias}.status")
    return (f"({alias}.service_type IS NOT NULL AND ("
            f"NOT EXISTS (SELECT 1 FROM r WHERE r.rule_name = {rn}) OR "
            f"EXISTS (SELECT 1 FROM r WHERE r.rule_name = {rn} "
            f"AND starts_with({alias}.service_type, r.value || ':'))))")


def not_in_rule(col: str, rule: str) -> str:
    return f"({col} IS NULL OR {col} NOT IN (SELECT value FROM r WHERE rule_name = '{rule}'))"


SCRUB_CTES = f"""{RULES_CTE},
{W_CTE},
{C_CTE},
open_rows AS (SELECT * FROM w WHERE is_billed IS DISTINCT FROM 'Yes'),
not_excluded AS (SELECT * FROM open_rows WHERE {not_in_rule('status', 'exclude_status')}),
gated AS (SELECT * FROM not_excluded e
  WHERE NOT coalesce(e.status IN ('No Show', 'Late Cancel', 'Kept'), false) OR {code_match('e')}),
looked AS (SELECT g.*, CASE WHEN contains(c.payor, 'United Healthcare') OR contains(c.payor, 'UnitedHealthcare')
    THEN 'Optum' ELSE c.payor END AS payor_name
  FROM gated g LEFT JOIN c ON g.client_id IS NOT DISTINCT FROM c.client_id),
manual AS (SELECT * FROM looked
  WHERE NOT coalesce(contains(staff, 'Inactive'), false) AND {not_in_rule('client_id', 'exception_client')}),
straight AS (SELECT * FROM manual
  WHERE payor_name IS NOT NULL
    AND try_strptime(substr(date_time, 1, 10), '%m/%d/%Y')::DATE
        BETWEEN {ASOF_SQL} - (CASE WHEN isodow({ASOF_SQL}) = 1 THEN 4 ELSE 2 END) AND {ASOF_SQL} - 2
    AND payor_name IS DISTINCT FROM 'Self Pay'),
billed AS (SELECT * FROM w WHERE is_billed = 'Yes'),
exc AS (SELECT * FROM billed b
  WHERE {not_in_rule('b.status', 'exclude_status')}
    AND NOT (b.status IS NOT DISTINCT FROM 'No Show' AND {code_match('b')})
    AND NOT (b.status IS NOT DISTINCT FROM 'Late Cancel' AND {code_match('b')})
    AND (b.status IS DISTINCT FROM 'Kept' OR {code_match('b')}))"""


def with_scrub(select: str) -> str:
    return f"WITH {SCRUB_CTES}\n{select}"


SQL: dict[str, str] = {
    "scrub_straightforward": with_scrub(f"SELECT {W_COLS}, payor_name FROM straight"),
    "scrub_manual": with_scrub(f"SELECT {W_COLS}, payor_name FROM manual"),
    "scrub_exception": with_scrub(f"SELECT {W_COLS} FROM exc"),
}


# ---- case work ------------------------------------------------------------------

NO_DX = NO_DX_LABEL


def cents_text(x: str) -> str:
    return f"concat(CAST(({x}) // 100 AS VARCHAR), '.', lpad(CAST(({x}) % 100 AS VARCHAR), 2, '0'))"


def first_row(src: str, part: str, order: str) -> str:
    return (f"(SELECT * EXCLUDE (rn) FROM (SELECT s.*, row_number() OVER "
            f"(PARTITION BY {part} ORDER BY {order}) AS rn FROM {src} s) WHERE rn = 1)")


def norm_name(a: str) -> str:
    return (f"trim(regexp_replace(concat_ws(' ', {a}.first_name, {a}.middle_name, {a}.last_name),"
            f" '\\s+', ' ', 'g'))")


G_COLS = """CASE WHEN c_custkey % 9 = 0 THEN concat('X', CAST(c_custkey AS VARCHAR))
      ELSE CAST(c_custkey AS VARCHAR) END AS client_id,
    concat(' Pat', CAST(c_custkey % 100 AS VARCHAR)) AS first_name,
    CASE WHEN c_custkey % 2 = 0 THEN 'Q.' END AS middle_name,
    concat('Doe  ', CAST(c_nationkey AS VARCHAR)) AS last_name,
    strftime(DATE '1980-01-01' + CAST(c_custkey % 9000 AS INTEGER), '%m/%d/%Y') AS dob,
    CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    concat(CAST(c_custkey AS VARCHAR), ' Main St') AS street,
    concat('City ', CAST(c_nationkey AS VARCHAR)) AS city,
    CASE c_nationkey % 3 WHEN 0 THEN 'New York' WHEN 1 THEN 'New Jersey' ELSE 'Connecticut' END AS state,
    lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip"""

CASE_CTES = f"""{SCRUB_CTES},
cases AS (SELECT s.*, CASE WHEN item_id % 5 = 0 THEN 'Archived' WHEN item_id % 5 = 1 THEN 'Active' END
    AS active_archived FROM straight s),
g AS (SELECT {G_COLS}, CASE WHEN c_custkey % 4 = 0 THEN 'Archived' ELSE 'Active' END AS tab
    FROM customer
  UNION ALL SELECT {G_COLS}, 'Active' FROM customer WHERE c_custkey % 12 = 0),
g_best AS {first_row('g', 'client_id', "CASE tab WHEN 'Active' THEN 0 WHEN 'Archived' THEN 1 ELSE 2 END")},
reg AS (SELECT c.*, b.client_id IS NOT NULL AS reg_found, b.tab AS reg_tab, b.first_name AS reg_first_name,
    b.last_name AS reg_last_name, b.dob AS reg_dob, b.gender AS reg_gender, b.street AS reg_street,
    b.city AS reg_city, b.state AS reg_state, b.zip AS reg_zip, {norm_name('b')} AS reg_full_name
  FROM cases c LEFT JOIN g_best b ON c.client_id = b.client_id),
l AS (SELECT o_orderkey AS line_id,
    CASE WHEN o_orderkey % 5 = 0 THEN concat('X', CAST(o_custkey AS VARCHAR))
      WHEN o_custkey % 17 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS client_id,
    concat(strftime(DATE '2026-11-20' + CAST(o_orderkey % 14 AS INTEGER), '%m/%d/%Y'), ', 10:00 AM') AS dos_text,
    CASE WHEN o_orderkey % 7 = 0 THEN '90834: other' WHEN o_orderkey % 11 <> 0 THEN concat(
      CASE o_orderkey % 4 WHEN 0 THEN '993' WHEN 1 THEN '90837' WHEN 2 THEN '90791' ELSE '999' END, ': svc')
      END AS service_type,
    CASE WHEN o_orderkey % 2 = 0 THEN '11' ELSE '02' END AS place_of_service,
    {cents_text('(o_orderkey * 37) % 20000 + 5000')} AS amount,
    CASE WHEN o_orderkey % 3 = 0 THEN '2' ELSE '1' END AS units,
    CASE WHEN o_orderkey % 13 = 0 THEN '{NO_DX}' ELSE concat('Anxiety (F41.', CAST(o_orderkey % 10 AS VARCHAR),
      ') and Depression (F32.', CAST(o_orderkey % 3 AS VARCHAR), ')',
      CASE WHEN o_orderkey % 4 = 0 THEN ' with (Z63.0)' ELSE '' END) END AS dx_text,
    o_orderkey AS position
  FROM orders),
pairs AS (SELECT DISTINCT c.client_id AS p_client, c.date_time AS p_dt, c.status AS p_status,
    c.service_type AS p_svc, l.*
  FROM cases c JOIN l ON c.client_id = l.client_id AND trim(replace(c.date_time, ' ET', '')) = l.dos_text
   AND (NOT coalesce(c.status IN ('Late Cancel', 'No Show'), false) OR c.service_type = l.service_type)),
line1 AS {first_row('pairs', 'p_client, p_dt, p_status, p_svc', 'position')},
svc AS (SELECT r.*, m.line_id AS ln_line_id, m.place_of_service AS ln_place_of_service,
    m.amount AS ln_amount, m.units AS ln_units, m.dx_text AS ln_dx_text, m.line_id IS NOT NULL AS svc_found
  FROM reg r LEFT JOIN line1 m ON r.client_id = m.p_client AND r.date_time = m.p_dt
   AND r.status IS NOT DISTINCT FROM m.p_status AND r.service_type IS NOT DISTINCT FROM m.p_svc),
charged AS (SELECT s.*, NOT coalesce(contains(ln_dx_text, '{NO_DX}'), false) AS dx_ok,
    CASE WHEN coalesce(status IN ('Late Cancel', 'No Show'), false) THEN '65.00' ELSE ln_amount END AS charge_amount,
    CASE WHEN coalesce(status IN ('Late Cancel', 'No Show'), false) THEN '65.00' ELSE '0.00' END AS client_amount,
    CASE WHEN coalesce(status IN ('Late Cancel', 'No Show'), false) THEN '0.00' END AS insurer_amount,
    CASE WHEN coalesce(status IN ('Late Cancel', 'No Show'), false) THEN ln_units ELSE '1' END AS quantity
  FROM svc s),
pp_raw AS (SELECT CASE n_nationkey WHEN 0 THEN 'Optum' WHEN 1 THEN 'Plan C' WHEN 2 THEN 'Optum'
      ELSE concat('Payer ', n_name) END AS payer,
    concat('Rendering ', n_name) AS rendering_provider,
    CASE WHEN n_nationkey % 3 = 0 THEN 'No' ELSE concat('Billing ', n_name) END AS billing_provider,
    n_nationkey AS position FROM nation),
ps_raw AS (SELECT CASE WHEN n_nationkey = 3 THEN 'Absent 3'
      ELSE concat('Staff ', CAST(n_nationkey AS VARCHAR)) END AS staff,
    concat('Rendering S', CAST(n_nationkey AS VARCHAR)) AS rendering_provider,
    CASE WHEN n_nationkey % 3 = 0 THEN 'No' ELSE concat('Billing S', CAST(n_nationkey AS VARCHAR)) END
      AS billing_provider,
    n_nationkey AS position FROM nation),
pv_raw AS (SELECT CASE WHEN n_nationkey = 5 THEN 'Absent 5' WHEN n_nationkey < 9
      THEN concat('Staff ', CAST(n_nationkey % 8 AS VARCHAR))
      ELSE concat('Staff ', CAST(n_nationkey AS VARCHAR)) END AS staff,
    concat('Rendering P', CAST(n_nationkey AS VARCHAR)) AS rendering_provider,
    concat('Billing P', CAST(n_nationkey AS VARCHAR)) AS billing_provider,
    concat(n_name, ' MD, NPI ', CAST(n_nationkey * 111 AS VARCHAR)) AS portal_rendering_provider,
    concat('Group ', CAST(n_regionkey AS VARCHAR), ', NPI 9') AS portal_billing_provider,
    n_nationkey AS position FROM nation),
pp AS {first_row('pp_raw', 'payer', 'position')},
ps AS {first_row('ps_raw', 'staff', 'position')},
pv AS {first_row('pv_raw', 'staff', 'position')},
src AS (SELECT c.*,
    coalesce(c.payor_name IN (SELECT value FROM r WHERE rule_name = 'private_payor'), false) AS is_private,
    CASE WHEN c.payor_name IN (SELECT value FROM r WHERE rule_name = 'private_payor') THEN 'staff_private'
      WHEN c.payor_name IN (SELECT value FROM r WHERE rule_name = 'staff_payor') THEN 'staff'
      ELSE 'payor' END AS provider_source
  FROM charged c),
resolved AS (SELECT s.*,
    CASE provider_source WHEN 'staff_private' THEN pv.rendering_provider WHEN 'staff' THEN ps.rendering_provider
      ELSE pp.rendering_provider END AS rendering_provider,
    CASE provider_source WHEN 'staff_private' THEN pv.billing_provider WHEN 'staff' THEN ps.billing_provider
      ELSE pp.billing_provider END AS billing_provider,
    CASE provider_source WHEN 'staff_private' THEN pv.staff IS NOT NULL WHEN 'staff' THEN ps.staff IS NOT NULL
      ELSE pp.payer IS NOT NULL END AS provider_found,
    CASE WHEN is_private THEN 'claim_file'
      WHEN coalesce(s.status IN ('Late Cancel', 'No Show'), false) THEN 'save_only'
      ELSE 'await_submission' END AS route
  FROM src s LEFT JOIN pv ON s.staff = pv.staff LEFT JOIN ps ON s.staff = ps.staff
    LEFT JOIN pp ON s.payor_name = pp.payer),
v AS (SELECT CAST(c_custkey AS VARCHAR) AS client_id,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Plan B' ELSE 'Plan C' END AS payor,
    CASE WHEN c_custkey % 3 = 0 THEN 'Inactive' ELSE 'Active' END AS status,
    concat('INS', CAST(c_custkey AS VARCHAR), 'A') AS insured_id, 0 AS position FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'Plan B',
    CASE WHEN c_custkey % 2 = 0 THEN 'Active' ELSE 'Inactive' END,
    concat('INS', CAST(c_custkey AS VARCHAR), 'B'), 1 FROM customer),
v_ok AS (SELECT * FROM v WHERE status = 'Active'
    AND payor IN (SELECT value FROM r WHERE rule_name = 'private_payor')),
cov AS {first_row('v_ok', 'client_id', 'position')},
inv AS (SELECT CASE WHEN o_custkey % 17 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS client_id,
    concat('INV', CAST(o_orderkey AS VARCHAR)) AS invoice_no, o_orderkey AS case_id, NULL::VARCHAR AS note,
    o_orderkey * 2 AS position
  FROM orders
  UNION ALL SELECT CASE WHEN o_custkey % 17 <> 0 THEN CAST(o_custkey AS VARCHAR) END,
    concat('INV', CAST(o_orderkey AS VARCHAR)), o_orderkey, 'copy', o_orderkey * 2 + 1 FROM orders WHERE o_orderkey % 10 = 0),
inv1 AS {first_row('(SELECT * FROM inv WHERE client_id IS NOT NULL)', 'client_id, case_id', 'position')},
o AS (SELECT event_id // 2 AS case_id, event_id AS seq, event_type <> 'error' AS ok,
    CASE WHEN event_type <> 'error' THEN concat('TXN', CAST(event_id AS VARCHAR)) END AS transaction_no,
    CASE WHEN event_type = 'error' THEN concat('Submission error ', props) END AS error_text FROM events),
lo AS (SELECT case_id, ok AS out_ok, transaction_no AS out_txn, error_text AS out_error
  FROM {first_row('o', 'case_id', 'seq DESC')}),
worked AS (SELECT x.*, cov.client_id IS NOT NULL AS cov_found, cov.insured_id AS cov_insured_id,
    inv1.invoice_no AS claim_invoice_number, lo.out_ok, lo.out_txn, lo.out_error,
    CASE WHEN NOT x.reg_found THEN 'Client Name or ID not found'
      WHEN NOT x.svc_found THEN 'No claims are present in particular DOS'
      WHEN NOT x.dx_ok THEN 'DX code not found'
      WHEN NOT x.provider_found THEN {_q(EXC_NO_PROVIDER)}
      WHEN x.route = 'claim_file' AND cov.client_id IS NULL THEN {_q(EXC_AWAITING)}
      WHEN x.route = 'await_submission' AND lo.case_id IS NOT NULL AND NOT lo.out_ok THEN {_q(EXC_AWAITING)}
    END AS exc
  FROM resolved x LEFT JOIN cov ON x.client_id = cov.client_id
    LEFT JOIN inv1 ON x.client_id = inv1.client_id AND x.item_id = inv1.case_id LEFT JOIN lo ON x.item_id = lo.case_id),
tagged AS (SELECT w.*, exc AS exceptions,
    CASE WHEN exc IS NULL AND (route IN ('save_only', 'claim_file') OR coalesce(out_ok, false)) THEN 'Yes'
      ELSE is_billed END AS tagged_billed,
    CASE WHEN route = 'await_submission' AND out_ok = false AND reg_found AND svc_found AND dx_ok
      AND provider_found THEN out_error END AS error_detail
  FROM worked w),
rec AS (SELECT item_id, reg_full_name AS client_name, client_id, date_time, service_type, staff, payor_name,
    reg_first_name AS first_name, reg_last_name AS last_name, reg_dob AS dob, reg_gender AS gender,
    reg_street AS street, reg_city AS city, reg_state AS state, reg_zip AS zip, claim_invoice_number,
    cov_insured_id AS insurance_number, ln_place_of_service AS place_of_service,
    array_to_string(list_transform(regexp_extract_all(ln_dx_text, '\\(([^)]+)\\)', 1),
      lambda x: replace(x, '.', '')), ',') AS dx_code,
    charge_amount, quantity
  FROM tagged WHERE route = 'claim_file' AND exceptions IS NULL)"""


def with_cases(select: str) -> str:
    return f"WITH {CASE_CTES}\n{select}"


REC_COLS = ("item_id, client_name, client_id, date_time, service_type, staff, payor_name, first_name, "
            "last_name, dob, gender, street, city, state, zip, claim_invoice_number, insurance_number, "
            "place_of_service, dx_code, charge_amount, quantity")

SQL.update({
    "registry_match": with_cases(
        "SELECT item_id, client_id, reg_found, reg_tab, reg_full_name FROM reg"),
    "registry_candidates": f"""WITH {CASE_CTES},
named AS (SELECT item_id, client_id, lower(CASE WHEN k % 5 = 0 THEN 'Alex Other' WHEN k % 7 = 0 THEN 'PAT' || (k % 100) || ' Before'
    ELSE 'Pat' || (k % 100) || CASE WHEN k % 2 = 0 THEN ' Q.' ELSE '' END || ' Doe ' || (k % 25) END) AS name
  FROM (SELECT item_id, client_id, CAST(client_id AS BIGINT) AS k FROM cases)),
listed AS (SELECT client_id, tab, 'Pat' || (k % 100) || CASE WHEN k % 2 = 0 THEN ' Q.' ELSE '' END || ' Doe ' || (k % 25) AS full_name
  FROM (SELECT client_id, tab, CAST(replace(client_id, 'X', '') AS BIGINT) AS k FROM g)),
terms AS (
  SELECT client_id, tab, full_name, CASE WHEN tab = 'Active' THEN 0 ELSE 2 END AS rank, 'full name' AS found_by, lower(full_name) AS term
  FROM listed
  UNION ALL SELECT client_id, tab, full_name, CASE WHEN tab = 'Active' THEN 1 ELSE 3 END, 'first token',
    unnest(list_distinct(string_split(lower(full_name), ' '))) FROM listed),
shown AS (SELECT rank, term, count(*) AS n_shown FROM terms GROUP BY rank, term),
found AS (
  SELECT item_id, t.client_id AS listed_id, t.tab, t.full_name, t.found_by, n_shown
  FROM named JOIN terms t ON t.client_id = named.client_id
    AND t.term = CASE WHEN t.found_by = 'full name' THEN name ELSE string_split(name, ' ')[1] END
  JOIN shown USING (rank, term)
  QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY t.rank) = 1)
SELECT item_id, client_id, listed_id IS NOT NULL AS reg_found, tab AS reg_tab, coalesce(full_name, '') AS reg_full_name, found_by,
  coalesce(n_shown, 0) AS n_shown
FROM named LEFT JOIN found USING (item_id)""",
    "archive_flag": with_cases("""SELECT item_id, active_archived,
        CASE WHEN reg_tab = 'Active' OR active_archived IS DISTINCT FROM 'Archived' THEN 'Active'
          WHEN reg_tab = 'Archived' THEN 'Archived' ELSE active_archived END AS new_active_archived,
        (reg_tab = 'Archived' OR active_archived IS NOT DISTINCT FROM 'Archived') AS needs_rearchive
      FROM reg WHERE reg_found"""),
    "normalise_name": with_cases(f"SELECT client_id, tab, {norm_name('g')} AS full_name FROM g"),
    "service_match_semi": with_cases(
        f"SELECT {W_COLS}, payor_name, active_archived FROM svc WHERE svc_found"),
    "service_match_anti": with_cases(
        f"SELECT {W_COLS}, payor_name, active_archived FROM svc WHERE NOT svc_found"),
    "extract_codes": with_cases("""SELECT line_id, array_to_string(list_transform(
        regexp_extract_all(dx_text, '\\(([^)]+)\\)', 1), lambda x: replace(x, '.', '')), ',') AS dx_codes FROM l"""),
    "charge_rule": with_cases("""SELECT item_id, status, charge_amount, client_amount, insurer_amount, quantity,
        CAST(CAST(charge_amount AS DECIMAL(12,2)) * 100 AS BIGINT) AS charge_cents
      FROM charged WHERE svc_found AND dx_ok"""),
    "provider_resolution": with_cases("""SELECT item_id, provider_source, rendering_provider, billing_provider,
        provider_found FROM resolved"""),
    "missing_master": with_cases(
        "SELECT item_id, provider_source, staff, payor_name FROM resolved WHERE NOT provider_found"),
    "duplicate_keys": with_cases("""
        SELECT 'client_export' AS master, client_id AS key, count(*) AS n_rows FROM c GROUP BY client_id HAVING count(*) > 1
        UNION ALL SELECT 'provider_by_payor', payer, count(*) FROM pp_raw GROUP BY payer HAVING count(*) > 1
        UNION ALL SELECT 'provider_by_staff', staff, count(*) FROM ps_raw GROUP BY staff HAVING count(*) > 1
        UNION ALL SELECT 'provider_by_staff_private', staff, count(*) FROM pv_raw GROUP BY staff HAVING count(*) > 1"""),
    "active_coverage": with_cases("SELECT client_id, payor, insured_id FROM cov"),
    "case_routing": with_cases("SELECT item_id, payor_name, status, route FROM resolved"),
    "exception_tagging": with_cases(
        "SELECT item_id, route, exceptions, error_detail, tagged_billed AS is_billed FROM tagged"),
    "claim_record": with_cases(f"SELECT {REC_COLS} FROM rec"),
    "diagnosis_explode": with_cases("""SELECT item_id, i - 1 AS slot, string_split(dx_code, ',')[i] AS code,
        i AS pointer FROM rec, range(1, len(string_split(dx_code, ',')) + 1) t(i)"""),
    "claim_assembly": with_cases("""SELECT rec.item_id, first_name AS patient_first_name,
        last_name AS patient_last_name, dob AS patient_dob, gender AS patient_gender, street AS patient_street,
        city AS patient_city, state AS patient_state,
        zip AS patient_zip, insurance_number AS member_id, payor_name AS payer,
        trim(split_part(pv.portal_rendering_provider, ',', 1)) AS rendering,
        trim(split_part(pv.portal_billing_provider, ',', 1)) AS billing,
        '1' AS frequency, 'A -' AS assignment, 'Y -' AS release_info, 'Yes' AS signature, place_of_service,
        claim_invoice_number AS control_number, len(string_split(dx_code, ',')) AS n_diagnoses,
        array_to_string(list_transform(range(0, len(string_split(dx_code, ','))), lambda x: CAST(x AS VARCHAR)), ',')
          AS dx_slots, dx_code AS dx_codes, 1::BIGINT AS n_service_lines,
        split_part(date_time, ',', 1) AS from_date, split_part(date_time, ',', 1) AS to_date,
        split_part(service_type, ':', 1) AS procedure_code, charge_amount AS amount, quantity,
        array_to_string(list_transform(range(1, len(string_split(dx_code, ',')) + 1), lambda x: CAST(x AS VARCHAR)), ',')
          AS pointers
      FROM rec LEFT JOIN pv ON rec.staff = pv.staff"""),
    "apply_outcome": with_cases(f"""SELECT item_id, route,
        CASE WHEN coalesce(out_ok, false) THEN 'Yes' ELSE is_billed END AS is_billed,
        CASE WHEN out_ok = false THEN {_q(EXC_AWAITING)} END AS exceptions,
        CASE WHEN out_ok = false THEN out_error END AS error_detail,
        CASE WHEN coalesce(out_ok, false) AND route = 'claim_file' THEN out_txn END AS transaction_number,
        CASE WHEN coalesce(out_ok, false) AND route = 'claim_file' THEN 'Yes' END AS submitted
      FROM worked WHERE route IN ('await_submission', 'claim_file')"""),
    "invoice_annotate": with_cases(f"""SELECT rec.item_id, rec.claim_invoice_number,
        CASE WHEN lo.out_ok THEN lo.out_txn END AS transaction_number,
        CASE WHEN lo.out_ok AND ip.pos IS NOT NULL THEN CAST(ip.pos AS VARCHAR) END AS invoice_position,
        CASE WHEN lo.out_ok AND ip.pos IS NOT NULL
          THEN concat('{_q(INVOICE_NOTE_PREFIX)[1:-1]}', lo.out_txn) END
          AS invoice_note,
        CASE WHEN lo.out_ok AND ip.pos IS NOT NULL THEN 'Transaction Number updated' END AS transaction_status
      FROM rec LEFT JOIN lo ON rec.item_id = lo.case_id
        LEFT JOIN (SELECT client_id, invoice_no, min(position) AS pos FROM inv GROUP BY ALL) ip
          ON rec.client_id = ip.client_id AND rec.claim_invoice_number = ip.invoice_no"""),
})


# ---- scalars, gates, sources -------------------------------------------------------

def lookback_where(asof_sql: str) -> str:
    return (f"try_strptime(substr(date_time, 1, 10), '%m/%d/%Y')::DATE BETWEEN {asof_sql} - "
            f"(CASE WHEN isodow({asof_sql}) = 1 THEN 4 ELSE 2 END) AND {asof_sql} - 2")


RAGGED = """cs AS (SELECT c_custkey AS ck FROM customer)"""

SQL.update({
    "scan_text": with_scrub(f"SELECT {W_COLS} FROM w"),
    "dated_run": with_scrub(f"""SELECT {W_COLS}, strftime({ASOF_SQL}, '%Y') AS run_year,
        strftime({ASOF_SQL}, '%m %b''%Y') AS run_month, strftime({ASOF_SQL}, '%m%d%Y') AS run_date FROM w"""),
    "route_sink": with_scrub(f"""SELECT {W_COLS}, NULL::VARCHAR AS payor_name, 'exception' AS route FROM exc
        UNION ALL SELECT {W_COLS}, payor_name, 'manual' FROM manual
        UNION ALL SELECT {W_COLS}, payor_name, 'straightforward' FROM straight"""),
    "rules_unpivot": f"""WITH {RAGGED}
        SELECT 'exclude_status' AS rule_name,
          CASE ck % 3 WHEN 0 THEN 'Canceled' WHEN 1 THEN 'Rescheduled' ELSE 'Upcoming' END AS value
          FROM cs WHERE ck % 50 = 0
        UNION ALL SELECT 'no_show_cpts', CAST(ck % 1000 AS VARCHAR) FROM cs WHERE ck % 7 = 0
        UNION ALL SELECT 'late_cancel_cpts', CAST(ck % 500 + 90000 AS VARCHAR) FROM cs WHERE ck % 11 = 0
        UNION ALL SELECT 'kept_cpts', CAST(ck % 300 AS VARCHAR) FROM cs WHERE ck % 13 = 0
        UNION ALL SELECT 'private_payor', concat('Plan ', CAST(ck % 5 AS VARCHAR)) FROM cs WHERE ck % 17 = 0
        UNION ALL SELECT 'exception_client', CAST(ck AS VARCHAR) FROM cs WHERE ck % 19 = 0
        UNION ALL SELECT 'staff_payor', concat('Payor ', CAST(ck % 4 AS VARCHAR)) FROM cs WHERE ck % 23 = 0""",
    "strip_headers": """SELECT CAST(c_custkey AS VARCHAR) AS client_id, c_name AS client_name,
        c_mktsegment AS payor FROM customer""",
    "project_rename_drop": with_scrub("SELECT client_id, payor AS payor_name FROM c"),
    "add_missing_columns": with_scrub(
        f"SELECT {W_COLS}, NULL::VARCHAR AS exceptions, NULL::VARCHAR AS active_archived FROM w"),
    "null_to_empty": with_scrub("""SELECT item_id, coalesce(client_id, '') AS client_id,
        coalesce(is_billed, '') AS is_billed, coalesce(status, '') AS status,
        coalesce(service_type, '') AS service_type, coalesce(date_time, '') AS date_time,
        coalesce(staff, '') AS staff FROM w"""),
    "recode_contains": with_scrub("""SELECT client_id, payor, CASE WHEN contains(payor, 'United Healthcare')
        OR contains(payor, 'UnitedHealthcare') THEN 'Optum' ELSE payor END AS payor_recoded FROM c"""),
    "code_prefix": with_scrub("""SELECT item_id, CASE WHEN strpos(service_type, ':') > 0
        THEN split_part(service_type, ':', 1) END AS code FROM w"""),
    "date_part_text": with_scrub("""SELECT item_id, split_part(date_time, ',', 1) AS date_text,
        substr(date_time, 1, 10) AS first10, trim(replace(date_time, ' ET', '')) AS no_zone,
        strftime(try_strptime(substr(date_time, 1, 10), '%m/%d/%Y'), '%Y-%m-%d') AS service_date FROM w"""),
    "split_parts": """SELECT CAST(c_custkey AS VARCHAR) AS client_id,
        trim(split_part(concat('Dr ', c_name, ' , NPI ', CAST(c_custkey AS VARCHAR)), ',', 1)) AS provider_head,
        regexp_extract(concat('/clients/details/', CAST(c_custkey AS VARCHAR)), '[^/]*$') AS url_id,
        string_split_regex(trim(concat('  ', c_name, '   Smith')), '\\s+')[1] AS first_token
      FROM customer""",
    "date_labels": """SELECT o_orderkey AS item_id, strftime(o_orderdate, '%m%d%Y') AS mmddyyyy,
        strftime(o_orderdate, '%m-%d-%Y') AS dashed, strftime(o_orderdate, '%m %b''%Y') AS month_label,
        strftime(CAST(o_orderdate AS DATE) - 1, '%m/%d/%Y') AS yesterday,
        strftime(date_trunc('month', o_orderdate), '%m/%d/%Y') AS month_start FROM orders""",
    "billed_split": with_scrub("""SELECT item_id, CASE WHEN is_billed IS NOT DISTINCT FROM 'Yes'
        THEN 'billed' ELSE 'open' END AS route FROM w"""),
    "status_exclusion": with_scrub(f"SELECT {W_COLS} FROM w WHERE {not_in_rule('status', 'exclude_status')}"),
    "client_exclusion": with_scrub(
        f"SELECT {W_COLS} FROM w WHERE {not_in_rule('client_id', 'exception_client')}"),
    "code_gate": with_scrub(f"""SELECT {W_COLS} FROM w e
        WHERE NOT coalesce(e.status IN ('No Show', 'Late Cancel', 'Kept'), false) OR {code_match('e')}"""),
    "billed_exception_gate": with_scrub(f"""SELECT {W_COLS} FROM billed b
        WHERE {not_in_rule('b.status', 'exclude_status')}
          AND NOT (b.status IS NOT DISTINCT FROM 'No Show' AND {code_match('b')})
          AND NOT (b.status IS NOT DISTINCT FROM 'Late Cancel' AND {code_match('b')})
          AND NOT (b.status IS NOT DISTINCT FROM 'Kept' AND {code_match('b')})"""),
    "inactive_blank_filter": with_scrub(f"""SELECT w.*, c.payor AS payor_name FROM w
        LEFT JOIN c ON w.client_id IS NOT DISTINCT FROM c.client_id
        WHERE NOT coalesce(contains(w.staff, 'Inactive'), false) AND c.payor IS NOT NULL"""),
    "business_day_lookback": with_scrub(f"SELECT {W_COLS} FROM w WHERE {lookback_where(ASOF_SQL)}"),
    "business_day_lookback_weekday": with_scrub(
        f"SELECT {W_COLS} FROM w WHERE {lookback_where(f'({ASOF_SQL} + 2)')}"),
    "payor_lookup": with_scrub(f"""SELECT w.*, c.payor AS payor_name FROM w
        LEFT JOIN c ON w.client_id IS NOT DISTINCT FROM c.client_id"""),
    "payor_lookup_first": with_scrub(f"""SELECT w.*, c1.payor AS payor_name FROM w
        LEFT JOIN {first_row('c', 'client_id', 'position')} c1 ON w.client_id IS NOT DISTINCT FROM c1.client_id"""),
    "stage_counts": with_scrub("""SELECT 'exception' AS route, count(*) AS n_rows FROM exc
        UNION ALL SELECT 'manual', count(*) FROM manual
        UNION ALL SELECT 'straightforward', count(*) FROM straight"""),
})


# ---- remittance ---------------------------------------------------------------------

D0 = f"strftime({ASOF_SQL}, '%m/%d/%Y')"
D1 = f"strftime({ASOF_SQL} - 1, '%m/%d/%Y')"

REMIT_CTES = f"""t AS (SELECT o_orderkey AS item_id, concat('NATION_', CAST(c_nationkey AS VARCHAR),
      CASE WHEN c_nationkey = 7 THEN ' branch' ELSE '' END) AS practice,
    CASE WHEN o_orderkey % 23 = 0 THEN concat_ws(chr(10), f1, f2, f3, f4)
      ELSE concat_ws(chr(10), f1, f2, f3, f4, f5, f6) END AS row_text
  FROM (SELECT o_orderkey, c_nationkey,
      concat('CHK', CAST(o_orderkey % 4000 AS VARCHAR)) AS f1,
      concat('Payer: ', c_mktsegment, CASE WHEN o_orderkey % 3 = 0 THEN ' / A|B*' ELSE '' END) AS f2,
      concat('Payee <', c_name, '>') AS f3,
      strftime({ASOF_SQL} - CAST(o_orderkey % 5 AS INTEGER), '%m/%d/%Y') AS f4,
      strftime({ASOF_SQL} - CAST(o_orderkey % 7 AS INTEGER), '%m/%d/%Y') AS f5,
      {cents_text('(o_orderkey * 53) % 100000 + 100')} AS f6
    FROM orders JOIN customer ON o_custkey = c_custkey)),
p AS (SELECT item_id, practice, parts[1] AS check_no, parts[2] AS payer, parts[3] AS payee,
    parts[4] AS check_date, parts[5] AS received_date, parts[6] AS amount, len(parts) >= 6 AS parse_ok
  FROM (SELECT item_id, practice, string_split(row_text, chr(10)) AS parts FROM t)),
ps AS (SELECT item_id, practice, check_no, regexp_replace(payer, '[:?/|''*<>]', '', 'g') AS payer,
    regexp_replace(payee, '[:?/|''*<>]', '', 'g') AS payee, check_date, received_date, amount, parse_ok FROM p),
cand AS (SELECT *, concat(concat_ws('_', coalesce(check_no, ''), coalesce(payer, ''), coalesce(payee, ''),
      coalesce(amount, '')), '.pdf') AS doc_name
  FROM ps WHERE parse_ok AND (received_date IN ({D0}, {D1}) OR check_date IN ({D0}, {D1}))),
prior AS (SELECT check_no FROM p WHERE item_id % 6 = 0),
dl AS (SELECT concat('/eob/', doc_name) AS path FROM cand WHERE item_id % 4 <> 0),
dl_names AS (SELECT DISTINCT regexp_extract(path, '[^/]*$') AS file FROM dl),
wl AS (SELECT concat('login', CAST(n_regionkey % 2 AS VARCHAR)) AS login,
    CASE WHEN n_nationkey % 6 = 5 THEN 'Nowhere'
      WHEN n_nationkey % 11 = 10 THEN concat('state ', CAST(n_regionkey AS VARCHAR))
      WHEN n_nationkey % 4 = 0 THEN 'Elsewhere' ELSE concat('State ', CAST(n_regionkey AS VARCHAR)) END AS state_name,
    concat('RSM ', CAST(n_nationkey % 3 AS VARCHAR)) AS rsm,
    CASE WHEN n_nationkey % 7 = 6 THEN 'Unknown practice' ELSE n_name END AS practice, n_nationkey * 2 AS position
  FROM nation
  UNION ALL SELECT concat('login', CAST(n_regionkey % 2 AS VARCHAR)), concat('State ', CAST(n_regionkey AS VARCHAR)),
    concat('RSM second ', CAST(n_nationkey % 3 AS VARCHAR)),
    CASE WHEN n_nationkey % 7 = 6 THEN 'Unknown practice' ELSE n_name END, n_nationkey * 2 + 1
  FROM nation WHERE n_nationkey % 4 = 0),
wls AS (SELECT wl.*, CASE
    WHEN lower(wl.state_name) NOT IN (SELECT concat('state ', CAST(r_regionkey AS VARCHAR)) FROM region)
      THEN 'State Not found'
    WHEN wl.state_name NOT IN (SELECT concat('State ', CAST(r_regionkey AS VARCHAR)) FROM region) THEN 'Unmatched'
    WHEN NOT EXISTS (SELECT 1 FROM nation WHERE n_name = wl.practice) THEN 'Practice name not found in Drop Down'
    WHEN NOT EXISTS (SELECT 1 FROM p WHERE p.practice = wl.practice AND p.check_date IN ({D0}, {D1}))
      THEN 'No EOBs for Cheque Date'
    ELSE 'Processed' END AS wl_status FROM wl),
fresh AS (SELECT * FROM cand WHERE check_date IN ({D0}, {D1}) AND practice IN (SELECT practice FROM wls WHERE wl_status = 'Processed')
    AND check_no NOT IN (SELECT check_no FROM prior))"""


def with_remit(select: str) -> str:
    return f"WITH {REMIT_CTES}\n{select}"


SQL.update({
    "parse_remit_row": with_remit("""SELECT item_id, practice, check_no, payer, payee, check_date,
        received_date, amount, parse_ok FROM p"""),
    "sanitise_text": with_remit("SELECT item_id, payer, payee FROM ps"),
    "remit_date_window": with_remit("SELECT item_id, check_no, check_date, received_date FROM cand"),
    "doc_name": with_remit("SELECT item_id, doc_name FROM cand"),
    "unseen_checks": with_remit(
        "SELECT item_id, check_no FROM cand WHERE check_no NOT IN (SELECT check_no FROM prior)"),
    "download_reconcile": with_remit("""SELECT item_id, doc_name, CASE WHEN doc_name IN (SELECT file FROM dl_names)
        THEN 'File Downloaded' ELSE 'File Not Downloaded' END AS status FROM cand"""),
    "worklist_status": with_remit("SELECT login, state_name, practice, rsm, wl_status FROM wls"),
    "remit_ledger": with_remit("""SELECT f.check_no, f.payer, f.payee, f.check_date, f.amount,
        CASE WHEN f.doc_name IN (SELECT file FROM dl_names) THEN 'File Downloaded' ELSE 'File Not Downloaded' END
          AS status, r.rsm
      FROM fresh f LEFT JOIN (SELECT practice, arg_min(rsm, position) AS rsm FROM wls
        WHERE wl_status = 'Processed' GROUP BY practice) r ON f.practice = r.practice"""),
    "parse_rejects": with_remit("SELECT t.item_id, t.practice, row_text FROM t JOIN p USING (item_id) WHERE NOT parse_ok"),
    "scan_text_split": with_remit("SELECT item_id, practice, row_text FROM t"),
    "distinct_keys": with_remit("SELECT DISTINCT check_no FROM prior"),
})


# ---- state log and file arrivals ---------------------------------------------------------

STATE_CTES = """sl AS (SELECT event_id // 3 AS case_id, event_id AS seq,
    CASE event_type WHEN 'purchase' THEN 'is_billed' WHEN 'error' THEN 'exceptions'
      WHEN 'signup' THEN 'active_archived' WHEN 'click' THEN 'transaction_number'
      WHEN 'view' THEN 'transaction_status' END AS field,
    CASE event_type WHEN 'purchase' THEN 'Yes' WHEN 'error' THEN concat('err ', props)
      WHEN 'signup' THEN CASE WHEN "value" > 50 THEN 'Archived' ELSE 'Active' END
      WHEN 'click' THEN concat('TXN', CAST(event_id AS VARCHAR))
      WHEN 'view' THEN 'Transaction Number updated' END AS value
  FROM events),
cur AS (SELECT case_id,
    arg_max(value, seq) FILTER (WHERE field = 'is_billed') AS is_billed,
    arg_max(value, seq) FILTER (WHERE field = 'exceptions') AS exceptions,
    arg_max(value, seq) FILTER (WHERE field = 'active_archived') AS active_archived,
    arg_max(value, seq) FILTER (WHERE field = 'transaction_number') AS transaction_number,
    arg_max(value, seq) FILTER (WHERE field = 'transaction_status') AS transaction_status
  FROM sl GROUP BY case_id),
inv_now AS (SELECT concat('/landing/', event_type, '/', CAST(event_id AS VARCHAR),
      CASE event_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.csv' ELSE '.xlsx' END) AS path,
    ts AS mtime, CAST(floor("value" * 100) AS BIGINT) AS length, event_id FROM events)"""

SQL.update({
    "state_current": f"WITH {STATE_CTES}\nSELECT * FROM cur",
    "pending_work": f"""WITH {STATE_CTES}
        SELECT case_id FROM cur WHERE is_billed IS DISTINCT FROM 'Yes' AND exceptions IS NULL""",
    "seed_or_resume": with_cases(f""", {STATE_CTES}
        SELECT case_id AS item_id, is_billed, exceptions, active_archived FROM cur
        UNION ALL SELECT DISTINCT item_id, NULL, NULL, NULL FROM cases
          WHERE item_id NOT IN (SELECT case_id FROM cur)""".replace("\n        SELECT", "\nSELECT", 1)),
    "new_arrivals": f"""WITH {STATE_CTES}
        SELECT path, length FROM inv_now
        WHERE path NOT IN (SELECT path FROM inv_now WHERE event_id % 4 <> 0) AND suffix(path, '.csv')""",
    "latest_arrival": f"""WITH {STATE_CTES},
      pdf AS (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, * FROM inv_now WHERE suffix(path, '.pdf'))
      SELECT folder, path, length, strftime(mtime, '%Y-%m-%d %H:%M:%S.%f') AS mtime
      FROM {first_row('pdf', 'folder', 'mtime DESC, path DESC')}""",
})


SQL.update({
    "pending_claims": with_cases("""SELECT rec.item_id, rec.client_id, rec.claim_invoice_number
        FROM rec LEFT JOIN lo ON rec.item_id = lo.case_id WHERE NOT coalesce(lo.out_ok, false)"""),
    "pending_annotations": with_cases("""SELECT rec.item_id, rec.claim_invoice_number,
        CASE WHEN lo.out_ok THEN lo.out_txn END AS transaction_number
        FROM rec LEFT JOIN lo ON rec.item_id = lo.case_id
        WHERE NOT (coalesce(lo.out_ok, false) AND EXISTS (SELECT 1 FROM inv
          WHERE inv.client_id = rec.client_id AND inv.invoice_no = rec.claim_invoice_number))"""),
})
