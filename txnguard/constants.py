"""Fixed values. They must equal the published ones for results to match."""

SENTINEL = -999.0

# --- fixed values: model feature order -------------------------------------
FEATURES = [
    "TransactionAmt", "card1", "card2", "card3", "card5", "addr1", "addr2", "dist1",
    "C1", "C2", "C5", "C13", "C14", "D1", "D2", "D4", "D10", "D15",
    "hour_of_day", "day_of_week", "is_night", "is_weekend",
    "log_amount", "amount_cents", "is_round_dollar", "is_high_amount",
    "email_mismatch", "p_email_missing", "r_email_missing",
    "ProductCD_freq", "card4_freq", "card6_freq", "P_emaildomain_freq", "R_emaildomain_freq",
    "M1_freq", "M2_freq", "M3_freq", "M4_freq", "M5_freq", "M6_freq", "M7_freq", "M8_freq", "M9_freq",
]

# --- fixed values: raw training columns ------------------------------------
RAW_NUMERIC = ["card1", "card2", "card3", "card5", "addr1", "addr2", "dist1", "dist2",
               "C1", "C2", "C5", "C13", "C14", "D1", "D2", "D4", "D10", "D15"]
RAW_CATEGORIES = ["ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain",
                  "M1", "M2", "M3", "M4", "M5", "M6", "M7", "M8", "M9"]
MODE_COLUMNS = ["card4", "card6", "R_emaildomain",
                "M1", "M2", "M3", "M4", "M5", "M6", "M7", "M8", "M9"]

# --- fixed values: product and merchant-category codes ----------------------
PRODUCT_TO_MCC = {"W": "5411", "C": "5732", "R": "5812", "H": "7011", "S": "5999"}
MCC_TO_PRODUCT = {"5411": "W", "5732": "C", "5812": "R", "7011": "H", "5999": "S"}
DEFAULT_PRODUCT = "S"
DEFAULT_MCC = "5999"

# --- fixed values: product and e-mail domain frequencies --------------------
PRODUCT_FREQUENCY = {"W": 0.7449, "C": 0.1276, "R": 0.0635, "H": 0.0498, "S": 0.0143}
PRODUCT_FREQUENCY_DEFAULT = 0.0143
DOMAIN_FREQUENCY = {
    "gmail.com": 0.4373, "yahoo.com": 0.1681, "hotmail.com": 0.0743, "anonymous.com": 0.0518,
    "aol.com": 0.0386, "icloud.com": 0.0263, "outlook.com": 0.0192, "comcast.net": 0.0119,
    "msn.com": 0.0089, "att.net": 0.0076, "verizon.net": 0.0066, "me.com": 0.0046,
    "live.com": 0.0042, "sbcglobal.net": 0.0036, "cox.net": 0.0031, "ymail.com": 0.0019,
    "charter.net": 0.0017, "optonline.net": 0.0011, "earthlink.net": 0.0009,
    "rocketmail.com": 0.0007, "nan": 0.0010, "missing": 0.0010,
}
DOMAIN_FREQUENCY_DEFAULT = 0.0050
MISSING_DOMAINS = ["missing", "nan", "anonymous.com"]

# --- fixed values: thresholds ------------------------------------------------
HIGH_AMOUNT = 200.0
REVIEW_AT = 0.50
BLOCK_AT = 0.85
DEMO_REVIEW_AT = 0.10
DEMO_BLOCK_AT = 0.18
EPOCH_2017_12_01_MS = 1_512_086_400_000
MISSING_DROP_ABOVE = 0.70
SUSPICIOUS_LOG_PPL = 6.0
PERPLEXITY_SLOPE = 0.5
LOG_PPL_CAP = 30.0
MAX_NARRATIVE_WORDS = 80
TOP_CONTRIBUTORS = 5
LLM_REQUESTS_PER_MINUTE = 25
LATENCY_BUDGET_MS = 100

# --- fixed values: entity lists ----------------------------------------------
ENTITY_COLUMNS = [("card", "card_token"), ("merchant", "merchant_id_hash"),
                  ("ip", "ip_address_hash"), ("device", "device_fingerprint_hash")]
ENTITY_TYPES = ["card", "merchant", "ip", "device"]
LISTS = ["block", "hot", "white"]
LIST_TTL_S = {"card": 24 * 3600, "merchant": 7 * 24 * 3600, "ip": 3600, "device": 24 * 3600}
WHITE_TTL_S = 30 * 24 * 3600
APPEAL_WHITE_TTL_S = 24 * 3600
MIN_BLOCK_COUNT = {"block": 3, "hot": 2}

# --- fixed values: velocity windows (label, seconds, threshold) --------------
VELOCITY_WINDOWS = [("1min", 60, 5), ("10min", 600, 12), ("60min", 3600, 25)]

# --- fixed values: feature names shown to analysts ---------------------------
FEATURE_LABELS = {
    "TransactionAmt": "transaction amount",
    "log_amount": "log-scaled amount",
    "amount_cents": "amount cents portion",
    "is_round_dollar": "round-dollar flag",
    "is_high_amount": "high-amount flag",
    "hour_of_day": "hour of day",
    "day_of_week": "day of week",
    "is_night": "night-time flag",
    "is_weekend": "weekend flag",
    "ProductCD_freq": "product-category frequency",
    "P_emaildomain_freq": "purchaser email frequency",
    "R_emaildomain_freq": "recipient email frequency",
    "p_email_missing": "purchaser email missing flag",
    "r_email_missing": "recipient email missing flag",
    "email_mismatch": "purchaser/recipient email mismatch",
    "card4_freq": "card-network frequency",
    "card6_freq": "card-type frequency",
    "addr1": "billing region",
    "addr2": "billing country",
    "dist1": "billing-to-merchant distance",
    "card1": "card hash bucket",
    "card2": "card-issuer bucket",
    "card3": "card-program bucket",
    "card5": "card-issuer ZIP bucket",
}

# --- fixed values: data-quality rules ----------------------------------------
BINARY_FLAGS = ["is_night", "is_weekend", "is_round_dollar", "is_high_amount",
                "email_mismatch", "p_email_missing", "r_email_missing"]
AMOUNT_RANGE = (0.0, 1_000_000.0)
HOUR_RANGE = (-999.0, 23.0)
WEEKDAY_RANGE = (-999.0, 6.0)
CLASS_BALANCE_SLACK = 0.01

# --- fixed values: release gates ----------------------------------------------
QUALITY_GATES = [("roc_auc", ">=", 0.90), ("recall", ">=", 0.80), ("fpr", "<=", 0.08), ("precision", ">=", 0.30)]

DECISIONS = ["ALLOW", "REVIEW", "BLOCK"]
