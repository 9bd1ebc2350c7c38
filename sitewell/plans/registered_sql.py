"""The same results as registered.py in plain SQL over the given tables, written independently of
the library: no text round trip, maps as conditions, one statement per query."""

from __future__ import annotations

from sitewell.operators.marts import FACILITY_CATEGORIES, PAYROLL_BURDEN_ACCOUNTS


def _listed(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


SYSTEM = ("CASE {k} % 7 WHEN 0 THEN 'open_dental' WHEN 1 THEN 'dentrix_ascend' WHEN 2 THEN 'sensei' "
          "WHEN 3 THEN 'dolphin' WHEN 4 THEN 'tdo' WHEN 5 THEN 'dentrix' ELSE 'dox' END")
PREFIX = ("CASE {k} % 7 WHEN 0 THEN 'OD-' WHEN 1 THEN '' WHEN 2 THEN 'SN-' WHEN 3 THEN '' "
          "WHEN 4 THEN 'TDO-' WHEN 5 THEN 'DX-' ELSE 'DOX-' END")
MONTH = "CAST(date_trunc('month', {d}) AS DATE)"
WEEK = "CAST(date_trunc('week', {d}) AS DATE)"

# typed facts; "all_" ones keep the site the crosswalk does not know
CTES = {
    "visit_orders": f"""
        SELECT o_orderkey, o_custkey, c_nationkey AS location_key, CAST(o_orderdate AS DATE) AS day,
               {SYSTEM.format(k='c_nationkey')} AS pms_system, {PREFIX.format(k='c_nationkey')} AS prefix,
               o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
        FROM orders JOIN customer ON c_custkey = o_custkey""",
    "all_procedures": f"""
        SELECT v.location_key, v.pms_system, prefix || o_orderkey AS appointment_id,
               md5(v.pms_system || prefix || o_custkey) AS patient_key, day AS service_date,
               {MONTH.format(d='day')} AS month,
               CASE WHEN s_acctbal < 4000 THEN 'Hygienist' ELSE 'Dentist' END AS provider_type,
               CASE WHEN l_quantity = 50 THEN NULL WHEN l_returnflag = 'N' THEN 'completed'
                    WHEN l_returnflag = 'R' THEN 'no_show' ELSE 'cancelled' END AS status,
               CASE WHEN l_returnflag = 'A' THEN NULL ELSE 'P' || l_partkey END AS cdt_code,
               CASE WHEN l_returnflag = 'A' THEN NULL ELSE coalesce(p_type, 'Unmapped code') END AS procedure_category,
               CASE WHEN l_returnflag = 'A' THEN FALSE ELSE coalesce(p_size = 1, FALSE) END AS is_new_patient_code,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS gross_production,
               CAST(l_quantity AS DECIMAL(18,2)) AS adjustments,
               CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity AS DECIMAL(18,2)) AS net_production
        FROM lineitem JOIN visit_orders v ON o_orderkey = l_orderkey
        LEFT JOIN supplier ON s_suppkey = l_suppkey AND
             CASE WHEN v.pms_system = 'dentrix_ascend' THEN s_nationkey % 7 = 1
                  WHEN v.pms_system IN ('dolphin', 'tdo') THEN FALSE ELSE s_nationkey = v.location_key END
        LEFT JOIN part ON p_partkey = l_partkey AND p_brand <> 'Brand#13'""",
    "procedures": "SELECT * FROM all_procedures WHERE location_key <> 7",
    "appointments": """
        SELECT location_key, pms_system, appointment_id, patient_key, service_date, month,
               max(provider_type) AS provider_type, max(status) AS status,
               bool_or(is_new_patient_code) AS is_new_patient, sum(gross_production) AS gross_production,
               sum(adjustments) AS adjustments, sum(net_production) AS net_production
        FROM procedures GROUP BY ALL""",
    "payments": f"""
        SELECT location_key, day AS paid_date, {MONTH.format(d='day')} AS month,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Insurance' ELSE 'Patient' END AS payer, amount
        FROM visit_orders WHERE location_key <> 7""",
    "all_supplied": f"""
        SELECT lineitem.*, s_nationkey AS location_key, CAST(l_shipdate AS DATE) AS day,
               {MONTH.format(d='l_shipdate')} AS month
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey""",
    "supplied": "SELECT * FROM all_supplied WHERE location_key <> 7",
    "labor_lines": """
        SELECT location_key, day AS work_date, month,
               CASE l_linenumber WHEN 1 THEN 'RDH01' WHEN 2 THEN 'DA01' WHEN 3 THEN 'EFDA01' WHEN 4 THEN 'FD01'
                    WHEN 5 THEN 'INS01' WHEN 6 THEN 'OM01' ELSE 'TEMP' END AS job_code,
               CASE WHEN l_linenumber = 1 THEN 'Hygienist' WHEN l_linenumber IN (2, 3) THEN 'Assistant'
                    WHEN l_linenumber IN (4, 5) THEN 'Front Office' WHEN l_linenumber = 6 THEN 'Manager'
                    ELSE 'Unmapped job' END AS role,
               CASE WHEN l_linenumber <= 3 THEN TRUE WHEN l_linenumber <= 6 THEN FALSE END AS is_clinical,
               CASE WHEN l_returnflag = 'N' THEN 'REG' WHEN l_returnflag = 'R' THEN 'OT'
                    WHEN l_linestatus = 'F' THEN 'PTO' ELSE 'BONUS' END AS earning_code,
               CAST(l_quantity AS DECIMAL(18,2)) AS hours,
               CAST(l_quantity AS DECIMAL(10,0)) * (CAST(l_tax AS DECIMAL(4,2)) * 100 + 20) AS base_cost
        FROM supplied""",
    "labor": """
        SELECT *, CASE earning_code WHEN 'REG' THEN TRUE WHEN 'OT' THEN TRUE WHEN 'PTO' THEN FALSE END AS is_productive,
               CASE earning_code WHEN 'REG' THEN FALSE WHEN 'OT' THEN TRUE WHEN 'PTO' THEN FALSE END AS is_overtime,
               CASE WHEN earning_code = 'PTO' THEN '6030' WHEN is_clinical THEN '6000' ELSE '6010' END AS account_no,
               CAST(CASE earning_code WHEN 'REG' THEN base_cost * 2 WHEN 'OT' THEN base_cost * 3
                    WHEN 'PTO' THEN base_cost * 2 END AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)) AS labor_cost
        FROM labor_lines""",
    "accounts": """
        SELECT * FROM (VALUES ('4000', 'Income', 'Revenue', FALSE, 'pms'), ('4900', 'Refunds', 'Revenue', FALSE, 'gl'),
            ('5100', 'Doctors', 'Doctor Compensation', TRUE, 'gl'), ('5200', 'Lab', 'Clinical Supplies & Lab', TRUE, 'gl'),
            ('5300', 'Supplies', 'Clinical Supplies & Lab', TRUE, 'inventory'),
            ('6000', 'Clinical wages', 'Staff Payroll & Benefits', TRUE, 'ukg'),
            ('6010', 'Office wages', 'Staff Payroll & Benefits', TRUE, 'ukg'),
            ('6030', 'Time off', 'Staff Payroll & Benefits', TRUE, 'ukg'),
            ('6050', 'Payroll tax', 'Staff Payroll & Benefits', TRUE, 'gl'), ('6100', 'Rent', 'Occupancy', TRUE, 'gl'),
            ('6150', 'Power', 'Utilities', TRUE, 'gl'), ('6600', 'Ads', 'Marketing', TRUE, 'marketing'))
        AS a(account_no, account_title, category, is_opex, mart_source)""",
    "booked": """
        SELECT location_key, month, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, l_linenumber,
               CASE l_linenumber WHEN 1 THEN '4000' WHEN 2 THEN '5200' WHEN 3 THEN '5300' WHEN 4 THEN '6000'
                    WHEN 5 THEN CASE l_returnflag WHEN 'N' THEN '6100' WHEN 'R' THEN '6050' ELSE '6150' END
                    WHEN 6 THEN '6600' ELSE CASE l_returnflag WHEN 'N' THEN '5100' WHEN 'R' THEN '4900' ELSE '9999' END
               END AS account_no
        FROM supplied""",
    "ledger": """
        SELECT location_key, month, account_no, 'account ' || account_no AS account_title,
               coalesce(category, 'Unmapped account') AS category, is_opex, mart_source,
               CASE WHEN account_no = '4900' THEN -price ELSE price END AS amount
        FROM booked LEFT JOIN (SELECT account_no, category, is_opex, mart_source FROM accounts) USING (account_no)""",
    "inventory": """
        SELECT location_key, month, l_partkey AS item_number,
               CASE WHEN l_linenumber <= 2 THEN 'Protection' WHEN l_linenumber <= 4 THEN 'Restorative'
                    WHEN l_linenumber = 5 THEN 'Hygiene' WHEN l_linenumber = 6 THEN 'Consumables'
                    ELSE 'Unmapped category' END AS category,
               CAST(l_quantity AS DECIMAL(10,0)) * (CAST(l_discount AS DECIMAL(4,2)) + 1) AS supply_cost,
               (50 - CAST(l_quantity AS DECIMAL(10,0))) * (CAST(l_discount AS DECIMAL(4,2)) + 1) AS on_hand_value
        FROM supplied""",
    "all_events": """
        SELECT c_nationkey AS location_key, event_type, CAST(value AS DECIMAL(18,2)) AS spend,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(ts AS DATE) AS day
        FROM events JOIN customer ON c_custkey = user_id""",
    "channel_rows": """
        SELECT location_key, CAST(DATE '1995-01-01' + to_months(k) AS DATE) AS month,
               CASE event_type WHEN 'click' THEN 'Search' WHEN 'view' THEN 'Meta' WHEN 'signup' THEN 'Organic'
                    WHEN 'purchase' THEN 'Direct' ELSE 'Other' END AS channel,
               event_type || ' campaign' AS campaign, spend, 3 AS sessions,
               CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS form_leads,
               CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS booked_appts
        FROM all_events WHERE location_key <> 7""",
    "daily_rows": f"""
        SELECT location_key, {MONTH.format(d='day + to_months(k - 348)')} AS month, 'Meta' AS channel, 'daily' AS campaign,
               spend, 1 AS sessions, 0 AS form_leads, 0 AS booked_appts
        FROM all_events WHERE event_type = 'view' AND location_key <> 7""",
    "marketing": "SELECT * FROM channel_rows UNION ALL SELECT * FROM daily_rows",
    "sites": f"""
        SELECT n_nationkey AS location_key, n_name AS location_name, r_name AS region, 'General' AS specialty,
               {SYSTEM.format(k='n_nationkey')} AS pms_system
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    # what every feed says was spent or earned, in one shape; how each is called on either side
    "spending": """
        SELECT 'pms' AS feed, location_key, month, amount FROM payments
        UNION ALL BY NAME SELECT 'gl' AS feed, location_key, month, account_no, amount FROM ledger
                          WHERE is_opex AND mart_source = 'gl'
        UNION ALL BY NAME SELECT 'ukg' AS feed, location_key, month, account_no, labor_cost AS amount FROM labor
        UNION ALL BY NAME SELECT 'inventory' AS feed, location_key, month, '5300' AS account_no, supply_cost AS amount
                          FROM inventory
        UNION ALL BY NAME SELECT 'marketing' AS feed, location_key, month, '6600' AS account_no, spend AS amount
                          FROM marketing""",
    "called": """
        SELECT * FROM (VALUES ('gl', NULL, NULL, 'Sage Intacct'), ('pms', 'Revenue', 'PMS payments', NULL),
            ('ukg', 'Staff Wages', 'UKG timecards', 'UKG'), ('inventory', 'Supplies', 'Inventory usage', 'Inventory'),
            ('marketing', 'Marketing', 'Marketing feed', 'Marketing feed')) c(feed, side, ops_source, source)""",
    "opex": """
        SELECT location_key, month, accounts.category, account_no, account_title, source, sum(amount) AS amount
        FROM spending JOIN called USING (feed) JOIN accounts USING (account_no) WHERE source IS NOT NULL GROUP BY ALL""",
    # one row per visit, payment and timecard, each with its own columns; the others are null
    "dated": f"""
        SELECT location_key, month, {WEEK.format(d='service_date')} AS week, 1 AS scheduled, gross_production,
               net_production, CASE WHEN provider_type = 'Hygienist' THEN gross_production ELSE 0 END AS hygiene_production,
               if(status = 'completed', 1, 0) AS completed_visits, if(status = 'no_show', 1, 0) AS no_shows,
               if(is_new_patient AND status = 'completed', 1, 0) AS new_patients
        FROM appointments
        UNION ALL BY NAME SELECT location_key, month, {WEEK.format(d='paid_date')} AS week, amount AS collections,
               CASE WHEN payer = 'Insurance' THEN amount ELSE 0 END AS insurance_collections FROM payments
        UNION ALL BY NAME SELECT location_key, month, {WEEK.format(d='work_date')} AS week, labor_cost,
               CASE WHEN is_overtime THEN labor_cost ELSE 0 END AS overtime_cost,
               CASE WHEN is_productive THEN hours ELSE 0 END AS labor_hours,
               CASE WHEN is_overtime THEN hours ELSE 0 END AS overtime_hours FROM labor""",
    "facts": f"""
        SELECT * FROM dated
        UNION ALL BY NAME SELECT location_key, month, amount AS total_opex,
               CASE category WHEN 'Doctor Compensation' THEN amount ELSE 0 END AS doctor_comp,
               CASE account_no WHEN '5200' THEN amount ELSE 0 END AS lab_fees,
               CASE WHEN account_no IN ({_listed(PAYROLL_BURDEN_ACCOUNTS)}) THEN amount ELSE 0 END AS payroll_taxes_benefits,
               CASE WHEN category IN ({_listed(FACILITY_CATEGORIES)}) THEN amount ELSE 0 END AS facility_costs FROM opex
        UNION ALL BY NAME SELECT location_key, month, supply_cost, on_hand_value AS inventory_on_hand FROM inventory
        UNION ALL BY NAME SELECT location_key, month, spend AS marketing_spend, form_leads AS leads,
               booked_appts AS booked_from_marketing FROM marketing""",
    "scorecard": """
        SELECT t.*, location_name, region, specialty, pms_system, collections - coalesce(total_opex, 0) AS operating_profit
        FROM (SELECT location_key, month, count(scheduled) AS scheduled,
                     sum(COLUMNS(* EXCLUDE (location_key, month, week, scheduled))) FROM facts
              GROUP BY location_key, month HAVING count(scheduled) > 0) t JOIN sites USING (location_key)""",
    "weekly": """
        SELECT location_key, week, count(scheduled) AS scheduled,
               sum(COLUMNS(* EXCLUDE (location_key, month, week, scheduled))) FROM dated
        GROUP BY location_key, week HAVING count(scheduled) > 0""",
    "operational": """
        SELECT location_key, month, side AS category, ops_source, sum(amount) AS ops_amount
        FROM spending JOIN called USING (feed) WHERE ops_source IS NOT NULL GROUP BY ALL""",
    "reconcilable": """
        SELECT location_key, month, side AS category, sum(amount) AS gl_amount
        FROM ledger JOIN called ON feed = mart_source WHERE ops_source IS NOT NULL GROUP BY ALL""",
    "both_sides": """
        SELECT *, gl_amount - ops_amount AS variance, CAST(variance AS DOUBLE) / nullif(CAST(ops_amount AS DOUBLE), 0)
               AS variance_pct
        FROM operational FULL JOIN reconcilable USING (location_key, month, category)""",
    "recon": "SELECT * FROM both_sides WHERE ops_source IS NOT NULL",
    "recon_full": "SELECT * FROM both_sides",
    "mix": """
        SELECT location_key, month, procedure_category, sum(gross_production) AS gross_production
        FROM procedures WHERE status = 'completed' AND cdt_code IS NOT NULL GROUP BY ALL""",
    "translated": """
        SELECT 'ukg_job' AS kind, job_code AS value, role AS became FROM labor
        UNION ALL SELECT 'inventory_item', CAST(item_number AS VARCHAR), category FROM inventory
        UNION ALL SELECT 'gl_account', account_no, category FROM ledger
        UNION ALL SELECT 'utm_campaign', campaign, channel FROM marketing
        UNION ALL SELECT 'cdt_code', cdt_code, procedure_category FROM procedures""",
    "unmapped": f"""
        SELECT 'location' AS kind, {SYSTEM.format(k='7')} || ' / office-7' AS value, count(*) AS row_count
        FROM all_procedures WHERE location_key = 7 HAVING count(*) > 0
        UNION ALL SELECT 'location', p.system || ' / ' || p.prefix || l_suppkey, count(*)
        FROM all_supplied, (VALUES ('ukg', 'U'), ('sage_intacct', 'E'), ('inventory', 'S')) p(system, prefix)
        WHERE location_key = 7 GROUP BY ALL
        UNION ALL SELECT 'location', 'marketing / site-7', count(*) FROM all_events WHERE location_key = 7 HAVING count(*) > 0
        UNION ALL SELECT 'location', 'windsor_facebook / act-7', count(*) FROM all_events
        WHERE location_key = 7 AND event_type = 'view' HAVING count(*) > 0
        UNION ALL SELECT kind, value, count(*) FROM translated JOIN (VALUES ('utm_campaign', 'Other'),
            ('gl_account', 'Unmapped account'), ('cdt_code', 'Unmapped code'), ('ukg_job', 'Unmapped job'),
            ('inventory_item', 'Unmapped category')) f(kind, became) USING (kind, became) GROUP BY ALL""",
}


def select(body: str) -> str:
    """``body`` with the common table expressions it needs, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
        for name in CTES:
            if name in words and name not in needed:
                needed.add(name)
                visit(CTES[name])

    visit(body)
    parts = [f"{name} AS ({sql})" for name, sql in CTES.items() if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def doubled(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def bigint(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)
