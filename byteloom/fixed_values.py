"""Values that other systems read back and that therefore must not drift."""

# --- fixed values: in-band sentinels -------------------------------------
REJECTED = "E#1"
SENTINEL_PREFIX = "E#"
DATA_ROW_MARKERS = ("62", "E#3", "null")

# --- fixed values: timestamp and date formats ----------------------------
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "MM-dd-yyyy"

# --- fixed values: labels of special raw values --------------------------
NOT_AVAILABLE = "Invalid/Not Available"
SENSOR_ERROR = "Invalid/Sensor Error"
NOT_INITIALIZED = "Not Initialized"
OUT_OF_RANGE = "Out of Range/Invalid"

# --- fixed values: (text in the field name, label of 1, other label) -----
NAME_FALLBACKS = (
    ("Present/Not present", "Present", "Not present"),
    ("Fault/No Fault", "Fault", "No Fault"),
    ("False / True", "True", "False"),
)

# --- fixed values: error texts (printf patterns, {} is filled per message) -
ERROR_PREFIX = "Error: "
BYTE_MISSING = "Byte %d not available in DDT string"
BAD_BIT_START = "Invalid bit_start %d, must be 0-7"
BAD_BIT_RANGE = "Invalid bit range: start=%d, count=%d"
BAD_BIT_POS = "Invalid bit_pos %d, must be 0-7"
BAD_BIT_OFFSET = "Invalid bit_offset %d, must be 0-7"
SHORT_DATA = (
    "Insufficient data: need bytes %d to %d, "
    "but only {} bytes available in DDT string"
)
NO_BYTE_BEFORE = "Cannot expand backward beyond byte 0"
NOT_HEX = "invalid literal for int() with base 16: '%s'"
NOT_DECIMAL = "invalid literal for int() with base 10: '%s'"
NAN_TO_INT = "cannot convert float NaN to integer"
CONVERSION_ERROR = "Conv Error: %s"
LABEL_CONVERSION_ERROR = " (Conv Error: %s)"
NO_LABEL = " (No match)"

# --- fixed values: message-level error texts -----------------------------
EMPTY_MESSAGE = "Empty DDT string"
UNMAPPED_MESSAGE = "DDT file mapping not found for %s"
LAYOUT_NOT_FOUND = "Structure file not found: %s"
EMPTY_LAYOUT = "Empty structure for %s"

# --- fixed values: file names under <root>/<family>/<year>/ --------------
LAYOUT_FILE = "DDT_{ecu}_{message}_{family}_{year}.json"
LINEAR_FILE = "conv_L_{ecu}_{family}_{year}.csv"
ENUM_FILE = "conv_T_{ecu}_{family}_{year}.csv"

# --- fixed values: expected hex length by family, year, message ----------
EXPECTED_LENGTHS = {
    "KM": {
        "2024": {"A001": 178, "A007": 182},
        "2025": {"A001": 178, "A007": 182},
        "2026": {"A001": 178, "A007": 182},
    },
    "DT": {
        "2024": {"A001": 184, "A007": 182},
        "2025": {"A001": 184, "A007": 182},
        "2026": {"A001": 184, "A007": 182},
    },
    "LB": {
        "2024": {"A001": 178},
        "2025": {"A001": 178},
        "2026": {"A001": 178},
    },
    "WL": {"2024": {"A001": 136, "A007": 206}},
    "WS": {"2025": {"A001": 136, "A007": 206}},
    "JL": {
        "2024": {
            "A0B3": 20,
            "A0B4": 16,
            "A0B5": 20,
            "A0B6": 18,
            "A0B7": 22,
            "0129": 56,
        }
    },
}
