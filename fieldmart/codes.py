"""Fixed values of the survey: codes, labels, required columns and canonical names."""

from __future__ import annotations

SKIPPED, UNKNOWN = -9, -7
COUNTRY_CODES = {"kenya": 2, "uganda": 1}
ID_PREFIXES = {"kenya": "SCR", "uganda": "SCR"}
FACILITY_COLUMNS = {"kenya": "health_facility_ke", "uganda": "health_facility_ug"}
FACILITIES = {
    "kenya": {21: "Homa Bay Teaching and Referral Hospital", 22: "Rachuonyo District Hospital", 23: "Suba District Hospital", 24: "Ndhiwa District Hospital", 99: "Other"},
    "uganda": {11: "Bushenyi HCIV", 12: "Ishaka Adventist Hospital (Bushenyi)", 13: "Ishongororo HCIV (Ibanda)", 14: "Ruhoko HCIV (Ibanda)", 99: "Other"},
}
REQUIRED = ("starttime", "stoptime", "countrycode", "tabletnum", "client_sex", "health_facility", "screening_id", "uniqueid")
MAY_BE_EMPTY = ("vdate", "age")
DATE_FORMAT = "d/M/yyyy H:m:s"
LANGUAGES = {"english": "English", "luganda": "Luganda", "runyonkole": "Runyankole", "runyankole": "Runyankole"}
ARMS = {
    "community benefits": "Community benefits", "education-based": "Education-based 1", "hiv risk assessment": "HIV Risk Assessment", "social norms - default": "Social Norms",
    "social norms - sex-age-matched": "Social Norms", "u=u messaging": "U=U Messaging", "reserved for you": '"Reserved for you" Messaging',
}
ARMS_WITHOUT_MESSAGES = ("Control (SOC)", "Incentive")
TERMINAL = ("DELIVERED", "FAILED", "NOT_FOUND")
QUEUE_STATES = ("pending", "sent", "failed", "skipped")
LOG_STATES = ("sent", "failed")
TRACKING = ("run_uuid", "file_name", "file_path", "extracted_at")
