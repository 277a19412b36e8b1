"""FIXED VALUES of the oracle, in their natural order: the reports' code lists as SQL
tables, and the column lists of their results.

The oracle reads only this module, the Spark plans only ``functions.codes``, so a wrong
value in either one shows as a difference.
"""

# FIXED VALUES: days from the reporting date to the policy's end, per status band.
STATUS_BANDS = """
status_bands(band, from_day, to_day) AS (VALUES
 ('not_in_window', 16, 1000000), ('outreach', 1, 15), ('grace_early', -15, 0), ('grace_late', -30, -16), ('overdue', -1000000, -31))"""
RENEWAL_CHANNELS = ["ONLINE", "CLINIC", "OFFLINE"]
WATCHLIST_ROWS = 80
FUNNEL_COLUMNS = ["not_in_window", "outreach", "grace_early", "grace_late", "overdue", "renewed", "total",
                  "rupees_in_window", "rupees_overdue", "rupees_renewed"]
LEADER_COLUMNS = ["total_accts", "renewed", "outreach", "grace", "overdue", "rupees_renewed", "rupees_overdue", "rupees_in_window"]

# FIXED VALUES: touchpoints by reason, dispositions by outcome, utilities by claim type, statuses of services that count.
CODE_TABLES = """
reasons(reason, by_pattern, bk_code, bk) AS (VALUES
 ('DAY_FIFTEEN', false, 0, 'Day 15'), ('DAY_SEVENTY_FIVE', false, 1, 'Day 75'), ('DAY_ONE_HUNDRED_FIFTY', false, 2, 'Day 150'),
 ('DAY_TWO_HUNDRED_TEN', false, 3, 'Day 210'), ('DAY_TWO_HUNDRED_SEVENTY', false, 4, 'Day 270'),
 ('OVERDUE_OPD_CLAIM', false, 5, 'OPD Reimbursement'), ('BAD_CSAT%', true, 6, 'Bad CSAT'),
 ('ENGMT_INACTIVE_ACCOUNT', false, 7, 'Engagement (Inactive)')),
outcomes(outcome, outcome_code, measure) AS (VALUES
 ('INTERESTED', 0, 'di'), ('INTERESTED_NSA', 0, 'di'), ('DNP', 1, 'ddnp'), ('DNP_REALLOCATE', 1, 'ddnp'), ('RESCHEDULED', 2, 'dre'),
 ('DND', 3, 'ddnd'), ('IGNORED', 4, 'dig'), ('WAIT_AND_WATCH', 5, 'dww'), ('LANGUAGE_BARRIER', 6, 'dlb'),
 ('OPEN_ND', 7, 'dop'), ('OPEN_REIMBURSEMENT', 7, 'dop'), (NULL, 8, 'dno')),
claims(claim_type, util_code, measure) AS (VALUES
 ('IN_HOUSE_CONSULT', 1, 'u_tele'), ('SCANNER', 2, 'u_scan'), ('HOME_COLLECTION', 3, 'u_tests'), ('NETWORK_VISIT', 4, 'u_visit'),
 ('OPD_VISIT', 4, 'u_visit'), ('REIMBURSEMENT', 5, 'u_opd')),
counted_statuses(status) AS (VALUES
 ('ACTIVE'), ('APPROVED'), ('DOCUMENTS_TO_BE_SUBMITTED'), ('REPORTS_UPLOADED'), ('RESCHEDULED'), ('SAMPLE_COLLECTED'),
 ('USER_ACTION_REQUIRED'), ('VERIFICATION_IN_PROGRESS'), ('INSURER_UNDER_REVIEW'), ('ON_HOLD'), ('UNDER_REVIEW'))"""
TOUCHPOINTS = ["Day 15", "Day 75", "Day 150", "Day 210", "Day 270", "OPD Reimbursement", "Bad CSAT", "Engagement (Inactive)"]
OUTCOME_LABELS = ["Interested", "DNP", "Rescheduled", "DND", "Ignored", "Wait & Watch", "Lang. Barrier", "Open", "No outcome"]
UTILITY_LABELS = ["—", "Teleconsult", "Scanner / HCU", "Tests (home)", "Clinic / Network visit", "OPD reimburse", "Other"]
PODS = ["B2C Postsales", "Postsales - Hindi", "Hospital PS"]
CREATED = ["accts", "pending", "forms"]
CALLS = ["calls", "bookings"]
UTILITIES = ["u_tele", "u_scan", "u_tests", "u_visit", "u_opd", "u_ipd", "u_other"]
DISPOSITIONS = ["di", "ddnp", "dre", "ddnd", "dig", "dww", "dlb", "dop", "dno"]
CONNECTED = ["di", "dre", "ddnd", "dww", "dlb", "dop"]
MEASURES = CREATED + CALLS + UTILITIES + ["u_any"] + DISPOSITIONS

# FIXED VALUES: rating weights, and band edges with the rating from each edge on.
WEIGHTS = {"frt": 0.20, "art": 0.20, "res": 0.05, "csat": 0.50, "vol": 0.05}
CSAT_EDGES = [(4.5, 5), (4.3, 4), (4.1, 3), (3.75, 2)]
FRT_EDGES = [(30, 5), (45, 4), (60, 3), (90, 2)]
ART_EDGES = [(90, 5), (105, 4), (120, 3), (150, 2)]
VOL_EDGES = [(50, 5), (40, 4), (35, 3), (31, 2)]
