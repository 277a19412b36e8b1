"""Fixed values that must equal the source reports' for the results to match.

FIXED VALUES -- code lists, labels, band edges and weights as the reports
define them, in their natural order.
"""

# Renewal channels kept by every renewals query.
CHANNELS = ["ONLINE", "CLINIC", "OFFLINE"]
# Label of the channel roll-up row.
ALL = "ALL"
# Policy years kept (inclusive).
CYCLE_MIN, CYCLE_MAX = 1, 4
# Renewal status bands on days-to-end d (d = policy end - as_of):
#   not_in_window d > 15; outreach 1..15; grace_early -15..0;
#   grace_late -30..-16; overdue d < -30.
# Watchlist size (global top-k by rounded premium).
WATCHLIST_SIZE = 80
UNASSIGNED = "Unassigned"

# Reach-out form type kept.
FORM_TYPE = "POSTSALES_REACHOUT"
# Touchpoint reason codes -> labels, codes 0..7 in display order. Reasons that
# start with BAD_CSAT (SQL LIKE 'BAD_CSAT%') map to "Bad CSAT"; anything else,
# null included, is "Other" / code 9 and is dropped everywhere.
REASONS = [
    ("DAY_FIFTEEN", "Day 15", 0),
    ("DAY_SEVENTY_FIVE", "Day 75", 1),
    ("DAY_ONE_HUNDRED_FIFTY", "Day 150", 2),
    ("DAY_TWO_HUNDRED_TEN", "Day 210", 3),
    ("DAY_TWO_HUNDRED_SEVENTY", "Day 270", 4),
    ("OVERDUE_OPD_CLAIM", "OPD Reimbursement", 5),
]
BAD_CSAT_PATTERN = "BAD_CSAT%"
BAD_CSAT_LABEL, BAD_CSAT_CODE = "Bad CSAT", 6
ENGAGEMENT_REASON, ENGAGEMENT_LABEL, ENGAGEMENT_CODE = "ENGMT_INACTIVE_ACCOUNT", "Engagement (Inactive)", 7
OTHER_LABEL, OTHER_CODE = "Other", 9
BUCKETS = ["Day 15", "Day 75", "Day 150", "Day 210", "Day 270",
           "OPD Reimbursement", "Bad CSAT", "Engagement (Inactive)"]

# Call outcomes -> disposition measure, and the raw-dump outcome code 0..8.
DISPOSITIONS = [
    ("di", ["INTERESTED", "INTERESTED_NSA"], 0, "Interested"),
    ("ddnp", ["DNP", "DNP_REALLOCATE"], 1, "DNP"),
    ("dre", ["RESCHEDULED"], 2, "Rescheduled"),
    ("ddnd", ["DND"], 3, "DND"),
    ("dig", ["IGNORED"], 4, "Ignored"),
    ("dww", ["WAIT_AND_WATCH"], 5, "Wait & Watch"),
    ("dlb", ["LANGUAGE_BARRIER"], 6, "Lang. Barrier"),
    ("dop", ["OPEN_ND", "OPEN_REIMBURSEMENT"], 7, "Open"),
]
NO_OUTCOME_CODE, NO_OUTCOME_LABEL = 8, "No outcome"
DISPOSITION_COLUMNS = ["di", "ddnp", "dre", "ddnd", "dig", "dww", "dlb", "dop", "dno"]
# "Connected" = member reached.
CONNECTED_COLUMNS = ["di", "dre", "ddnd", "dww", "dlb", "dop"]

# First qualifying service after a reach-out: status, visit type, excluded type.
SERVICE_STATUSES = ["ACTIVE", "APPROVED", "DOCUMENTS_TO_BE_SUBMITTED", "REPORTS_UPLOADED",
                    "RESCHEDULED", "SAMPLE_COLLECTED", "USER_ACTION_REQUIRED",
                    "VERIFICATION_IN_PROGRESS", "INSURER_UNDER_REVIEW", "ON_HOLD", "UNDER_REVIEW"]
SERVICE_VISIT_TYPE = "OPD"
SERVICE_EXCLUDED_CLAIM = "MEDICINE_HOME_DELIVERY"
# Claim type -> utility measure and raw-dump utility code (0 = none, 6 = other).
UTILITIES = [
    ("u_tele", ["IN_HOUSE_CONSULT"], 1, "Teleconsult"),
    ("u_scan", ["SCANNER"], 2, "Scanner / HCU"),
    ("u_tests", ["HOME_COLLECTION"], 3, "Tests (home)"),
    ("u_visit", ["NETWORK_VISIT", "OPD_VISIT"], 4, "Clinic / Network visit"),
    ("u_opd", ["REIMBURSEMENT"], 5, "OPD reimburse"),
]
UTIL_NONE_CODE, UTIL_OTHER_CODE = 0, 6
UTIL_CODE_LABELS = ["—", "Teleconsult", "Scanner / HCU", "Tests (home)",
                    "Clinic / Network visit", "OPD reimburse", "Other"]
UTILITY_COLUMNS = ["u_tele", "u_scan", "u_tests", "u_visit", "u_opd", "u_ipd", "u_other"]
DISPOSITION_LABELS = ["Interested", "DNP", "Rescheduled", "DND", "Ignored", "Wait & Watch",
                      "Lang. Barrier", "Open", "No outcome"]

# In-call booking: five form-info groups, each with three keys. Two groups are
# flattened columns, three are JSON documents.
FLAT_GROUPS = ["day75", "day150"]
JSON_GROUPS = ["day15", "day210", "day270"]
BOOK_ON_CALL = "BOOK_ON_CALL"

# activity_day row layout (25 columns).
ACTIVITY_KEYS = ["d", "ag", "bk"]
CREATED_MEASURES = ["accts", "pending", "forms"]
CALL_MEASURES = ["calls", "bookings"]
UTIL_MEASURES = ["u_tele", "u_scan", "u_tests", "u_visit", "u_opd", "u_ipd", "u_other", "u_any"]
ACTIVITY_MEASURES = CREATED_MEASURES + CALL_MEASURES + UTIL_MEASURES + DISPOSITION_COLUMNS

# Agent ranking: weights and band edges.
WEIGHTS = {"frt": 0.20, "art": 0.20, "res": 0.05, "csat": 0.50, "vol": 0.05}
# CSAT: >=4.5 5, >=4.3 4, >=4.1 3, >=3.75 2, else 1; missing -> 0.
CSAT_EDGES = [(4.5, 5), (4.3, 4), (4.1, 3), (3.75, 2)]
# First response seconds: <=30 5, <=45 4, <=60 3, <=90 2, else 1.
FRT_EDGES = [(30, 5), (45, 4), (60, 3), (90, 2)]
# Every-chat response seconds: <=90 5, <=105 4, <=120 3, <=150 2, else 1.
ART_EDGES = [(90, 5), (105, 4), (120, 3), (150, 2)]
# Volume (total in bucket): >=50 5, >=40 4, >=35 3, >=31 2, else 1.
VOL_EDGES = [(50, 5), (40, 4), (35, 3), (31, 2)]
PODS = ["B2C Postsales", "Postsales - Hindi", "Hospital PS"]

# Percent classes.
PCT_GOOD, PCT_WARN = 50, 30
# Raw dump display cap and history.
RAW_DISPLAY_CAP = 3000
RAW_HISTORY_MONTHS = 3
# Refresh metadata zone and format.
META_ZONE = "Asia/Kolkata"
