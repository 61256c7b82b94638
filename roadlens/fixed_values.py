"""Fixed values.

Every value below must equal the behaviour being reproduced (lookup tables,
thresholds, word lists, labels).  They are stated plainly and in their
natural order; the code elsewhere only refers to them.
"""

# ---------------------------------------------------------------- FIXED VALUES
# Raw inventory header -> canonical column name.
HEADER_TO_CANONICAL = {
    "ID": "record_id",
    "Location - Street Name1": "street_name",
    "From - Street Name2": "intersection1",
    "To - Street Name3": "intersection2",
    "Road Classification": "road_type",
    "Status": "status",
    "Date Data Requested": "requested_analysis_date",
    "Date Data Received": "received_analysis_date",
    "Street Operation": "street_operation",
    "Volume (vpd)": "volume_vpd",
    "Posted Speed Limit (km/h)": "posted_speed_limit",
    "Average Speed (km/h)": "average_speed",
    "85th Percentile Speed (km/h)": "percentile_speed_85",
    "Staff Recommended2": "analysis_recommended",
    "Plan/Drawing Number": "plan_number",
    "Estimated Cost": "estimated_cost",
    "Comments": "comments",
    "Speed Humps": "num_speed_humps",
    "Laneway Speed Bump": "num_speed_bumps",
    "Ranking": "priority_ranking",
}

# camelCase export key -> canonical column name.
CAMEL_TO_CANONICAL = {
    "recordId": "record_id",
    "status": "status",
    "streetName": "street_name",
    "intersection1": "intersection1",
    "intersection2": "intersection2",
    "roadType": "road_type",
    "requestedAnalysisInfoDate": "requested_analysis_date",
    "receivedAnalysisInfoDate": "received_analysis_date",
    "streetOperation": "street_operation",
    "volume": "volume_vpd",
    "postedSpeedLimit": "posted_speed_limit",
    "averageSpeed": "average_speed",
    "percentileSpeed85": "percentile_speed_85",
    "analysisRecommended": "analysis_recommended",
    "planNumber": "plan_number",
    "estimatedCost": "estimated_cost",
    "comments": "comments",
    "numSpeedHumps": "num_speed_humps",
    "numSpeedBumps": "num_speed_bumps",
    "priorityRanking": "priority_ranking",
}

# Street suffix abbreviations and their full forms.
SUFFIX_MAP = {
    "av": "Avenue",
    "ave": "Avenue",
    "aved": "Avenue",
    "ave.": "Avenue",
    "ave e": "Avenue East",
    "ave w": "Avenue West",
    "blvd": "Boulevard",
    "blvd.": "Boulevard",
    "blvd w": "Boulevard West",
    "blvd e": "Boulevard East",
    "cir": "Circle",
    "crcl": "Circle",
    "cres": "Crescent",
    "crt": "Court",
    "dr": "Drive",
    "dr s": "Drive South",
    "gdn": "Gardens",
    "gdns": "Gardens",
    "gt": "Gate",
    "hill": "Hill",
    "lwn": "Lawn",
    "park ave": "Park Avenue",
    "pkwy": "Parkway",
    "pl": "Place",
    "rd": "Road",
    "rd.": "Road",
    "st": "Street",
    "st.": "Street",
    "st e": "Street East",
    "st w": "Street West",
    "st s": "Street South",
    "ter": "Terrace",
    "trl": "Trail",
}

# Direction abbreviations and their full names.
DIRECTION_MAP = {
    "n": "North",
    "s": "South",
    "e": "East",
    "w": "West",
    "north": "North",
    "south": "South",
    "east": "East",
    "west": "West",
}

# An address ending in one of these (case-insensitive, no word boundary) is
# already standardised.
STANDARD_SUFFIXES = ["Street", "Avenue", "Boulevard", "Road", "Drive",
                     "Lane", "Court", "Place", "Parkway", "Terrace",
                     "Square", "Circle", "Trail", "Alley", "Cove", "Crescent"]

# Characters the address cleaner keeps: letters, digits, space, period, apostrophe.
ADDRESS_KEEP_CLASS = "[^A-Za-z0-9 .']"

# Characters the text cleaner removes: CR, LF, tab, NUL, U+FFFD.
CLEAN_REMOVE_CHARS = ["\r", "\n", "\t", "\x00", "�"]

# Volume multiplier of the heuristic predictor per road class (else 1.0).
ROAD_MULTIPLIER = {"Residential": 0.8, "Collector": 1.2, "Arterial": 1.5, "Highway": 2.0}
DEFAULT_MULTIPLIER = 1.0
HEURISTIC_HOUR = 14
TIME_FACTOR_AMPLITUDE = 0.2

# Ordinal encoding of the road class for model features.
ROAD_TYPE_CODE = {"Residential": 1, "Collector": 2, "Arterial": 3, "Highway": 4}

# Volume category: right-closed bins and labels.
VOLUME_BINS = [0, 1000, 3000, 5000, float("inf")]
VOLUME_LABELS = ["Low", "Medium", "High", "Very High"]

# Congestion by compliance ratio (avg / limit): < 0.8 High, < 1.0 Medium, else Low.
CONGESTION_RATIO_HIGH = 0.8
CONGESTION_RATIO_MEDIUM = 1.0
# Congestion by speed: < 0.7 x limit High, < 0.9 x limit Medium, else Low.
CONGESTION_SPEED_HIGH = 0.7
CONGESTION_SPEED_MEDIUM = 0.9
STREAM_DEFAULT_SPEED_LIMIT = 50

# Speed violation factors (dashboard 1.1, alerts and rules 1.2).
VIOLATION_FACTOR_DASHBOARD = 1.1
VIOLATION_FACTOR_ALERT = 1.2
# Volume anomaly: above k x global mean.
VOLUME_ANOMALY_K_SIMPLE = 2.0
VOLUME_ANOMALY_K_DASHBOARD = 1.5

# Scoring request formula.
SCORING_VOLUME_FACTOR = 1.1
SCORING_CONFIDENCE = 0.85
SCORING_SCORE_VIOLATION = 0.1
SCORING_SCORE_NORMAL = 0.3
SCORING_ANOMALY_BELOW = 0.2
HEURISTIC_CONFIDENCE = 0.85

# Column quality rules (volume is the canonical volume_vpd).
QUALITY_RULES = {
    "volume": {"min_value": 0, "max_value": 50000, "required": True, "null_allowed": False},
    "average_speed": {"min_value": 0, "max_value": 200, "required": True, "null_allowed": False},
    "posted_speed_limit": {"min_value": 10, "max_value": 120, "required": True, "null_allowed": False},
    "percentile_speed_85": {"min_value": 0, "max_value": 200, "required": False, "null_allowed": True},
    "street_name": {"min_length": 2, "max_length": 100, "required": True, "null_allowed": False},
    "record_id": {"pattern": r"^[A-Z]-\d{3}$", "required": True, "null_allowed": False},
}
COMPLETE_PCT = 95.0
DUPLICATE_ACCEPTABLE_SHARE = 0.05
ZSCORE_LIMIT = 3.0
OUTLIER_HIGH_SHARE = 0.05
COLUMN_ISSUE_CAP = 0.2
SEVERITY_DEDUCTION = {"high": 0.1, "medium": 0.05, "low": 0.02}

# Expected volume range per road class (business rule 2).
VOLUME_RANGES = {
    "Residential": (0, 2000),
    "Collector": (500, 5000),
    "Arterial": (1000, 10000),
    "Highway": (2000, 20000),
}

# Row quality score: critical fields and deductions.
ROW_CRITICAL_FIELDS = ["record_id", "street_name", "volume_vpd", "average_speed"]
ROW_MISSING_DEDUCTION = 0.2
ROW_NEGATIVE_DEDUCTION = 0.1

# Event envelope constants.
ENVELOPE_EVENT_TYPE = "data_update"
ENVELOPE_SEVERITY = 1
ENVELOPE_DEFAULT_CONFIDENCE = 1.0

# Latest-metric time to live, seconds.
METRIC_TTL_SECONDS = 300

# Spellings of a missing value in a CSV (the empty one is missing by itself).
MISSING_TOKENS = ["#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                  "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Fuzzy street matching threshold.
FUZZY_THRESHOLD = 0.7
# First row id of the positional street list.
POSITIONAL_FIRST_ID = 371

# Attachment content types by extension.
CONTENT_TYPES = {"pdf": "application/pdf", "png": "image/png",
                 "jpg": "image/jpeg", "jpeg": "image/jpeg"}
DEFAULT_CONTENT_TYPE = "application/octet-stream"
MAX_FILES_PER_RECORD = 8

# Legacy device count columns (nested export), in order, with export keys.
LEGACY_DEVICE_FIELDS = [
    ("Chicanes", "legacy_numChicanes"),
    ("Gateways", "legacy_numGateways"),
    ("Intersection Narrowings", "legacy_numIntersectionNarrowings"),
    ("Mid-Block Pinch Points", "legacy_numMidBlockPinchPoints"),
    ("Raised Center Medians", "legacy_numRaisedCenterMedians"),
    ("Raised Crosswalks", "legacy_numCrosswalks"),
    ("Raised Intersections", "legacy_numRaisedIntersections"),
    ("Traffic Circles", "legacy_numTrafficCircles"),
]
# Constant blank fields of the nested export.
EXPORT_BLANK_FIELDS = ["requestTrackingNumber", "percentileSpeed95", "locationWarranted",
                       "reportType", "initialSpeedCushions", "initialSpeedHumps",
                       "initialSpeedBumps", "otherDeviceInformation", "numSpeedCushions",
                       "numIslands"]
# Old database columns of the nested export, in order; the key is oldDB_ and the name without spaces.
LEGACY_OLD_FIELDS = [
    "newid", "Initiator", "Request Received", "Semi-formal Initiation", "Investigator", "Ward Number/Name",
    "Councillors", "Community Council", "Community Council 2018", "Petition Waived by Council",
    "Community Safety Zone", "Petition Waived by GM", "Traffic Plan Requested", "Traffic Plan Received",
    "Staff Recommended", "Staff Recommended(YES/NO)", "Actual Cost", "Account Number", "Budget Year",
    "1st Recommendations Amended", "1st Recommendations Amended(YES/NO)", "New Polling Waived",
    "Date Poll Sent Out", "Date Poll Closed", "% Poll Response", "% Support", "Negative Poll", "Poll Result 2",
    "Poll Result", "EA 1st Notice of Commencement", "EA 2nd Notice of Commencement",
    "Start Road Alteration Advertising", "End Road Alteration Advertising", "Second Report Date to CC",
    "Council Approved", "Recommendations Amended", "Recommendations Amended(YES/NO)",
    "EA Notice of Completion Open", "EA Notice of Completion Closed", "Field Marks - Received",
    "Field Marks - Marked By", "Field Marks - Completed", "Signage Date - Requested",
    "Construction Details Referred To", "Construction Details Received", "Construction Details Consideration",
    "Construction Details Section", "Person Notified", "Date of Notification", "Frmr CoT Point Value",
    "Number of INJ Collisions", "Number of PDO Collisions", "Number of Ped & Bike Factors", "Old Ward Number",
    "Old Ward Name", "New Ward Name", "New Ward #-Name 2018", "Old Community Council", "Warrant 1", "Warrant 2",
    "Warrant 3", "Total Number of Devices", "Position", "First Report Date to Standing Committee",
    "2nd Recommendations Amended", "2nd Recommendations Amended(YES/NO)", "Maintenance Year", "Ward2018", "NewDist",
]
# Keys at the end of the nested export: two empty lists, then four empty texts.
EXPORT_EMPTY_LISTS = ["appendItems", "uploadDraftPlan"]
EXPORT_BLANK_TAIL = ["requestTrackingNumberDescription", "eligibility", "eligibilityReasons", "eligibilityOther"]
# Canonical record: name and coercion kind, in export order.
CANONICAL = [
    ("record_id", "s"), ("status", "s"), ("street_name", "s"), ("intersection1", "s"),
    ("intersection2", "s"), ("road_type", "s"), ("requested_analysis_date", "d"),
    ("received_analysis_date", "d"), ("street_operation", "s"), ("volume_vpd", "i"),
    ("posted_speed_limit", "i"), ("average_speed", "f"), ("percentile_speed_85", "f"),
    ("analysis_recommended", "s"), ("plan_number", "s"), ("estimated_cost", "f"),
    ("comments", "s"), ("num_speed_humps", "i"), ("num_speed_bumps", "i"),
    ("priority_ranking", "i"),
]
STREET_FIELDS = ("street_name", "intersection1", "intersection2")
# Removal keys.
REMOVAL_KEYS = ["removalContractNumber", "removalDate", "removalReason", "removed"]
# Council report keys.
REPORT_KEYS = ["ccAgendaItem", "ccApproval", "ccRecommendation", "ccReportDate", "ccReportLink"]

# Isolation forest settings.
IFOREST_TREES = 100
IFOREST_SAMPLE = 256
IFOREST_CONTAMINATION = 0.1
SEED = 42
# Features of a prediction request that does not name them.
FEATURE_DEFAULTS = {"speed_limit": 50, "average_speed": 45, "percentile_speed_85": 55, "time_of_day": 12,
                    "day_of_week": 1, "road_type_encoded": 2}
# Boosted trees settings.
GBT_ROUNDS = 100
GBT_DEPTH = 6
GBT_STEP = 0.1
# ------------------------------------------------------------ END FIXED VALUES
