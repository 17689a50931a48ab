"""Fixed values of the order domain.

Everything here must equal the agreed business values for the results to be
right: code lists, spelling rules (first match wins, so their order matters),
synonyms, tolerances and report texts.
"""

from __future__ import annotations

from decimal import Decimal

# The fifty state codes that count as valid (no DC, no territories).
STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]

# Product spellings. The fragments are looked up in the product key
# (lower case, without blanks and hyphens); the first rule with a hit names the product.
PRODUCT_RULES = [
    ("Adirondack Chair", ["adirondackchair"]),
    ("Patio Dining Table", ["patiodiningtabl"]),
    ("Garden Bench", ["gardenbench"]),
    ("Sun Lounger", ["sunloung"]),
    ("Hammock", ["hammok", "hammock"]),
    ("Leaf Blower", ["leafblow"]),
    ("Garden Hose", ["gardenhose"]),
    ("Pruning Shears", ["pruning", "prunning"]),
    ("Wheelbarrow", ["wheelbarrow", "wheelbar"]),
    ("Trowel Set", ["trowl", "trowelset"]),
    ("Gas Grill", ["gasgril"]),
    ("Charcoal Grill", ["charcoalgril", "charcolgril"]),
    ("BBQ Tool Set", ["bbqtool", "bbqtoolset"]),
    ("Grill Cover", ["grillcov"]),
    ("Fire Pit", ["firepit"]),
    ("Solar Lantern", ["solarlantr", "solarlantern"]),
    ("String Lights", ["stringlight"]),
    ("Pathway Light", ["pathlight", "pathwaylight"]),
    ("Deck Light", ["decklight"]),
    ("Flood Light", ["floodlight"]),
    ("Wind Chime", ["windchime"]),
    ("Bird Bath", ["birdbath"]),
    ("Garden Statue", ["gardenstateu", "gardenstatue"]),
    ("Plant Pot", ["plntpot", "plantpot"]),
    ("Wall Planter", ["wallplantr", "wallplanter"]),
]

# Category patterns on the trimmed lower-case text, first match wins.
CATEGORY_RULES = [
    ("Furniture", r"furniture"),
    ("Garden Tools", r"garden.?tool"),
    ("BBQ & Grilling", r"bbq|grill"),
    ("Lighting", r"light"),
    ("Outdoor Decor", r"decor|outdoor.?decor"),
]

# Store patterns on the trimmed lower-case text, first match wins.
STORE_RULES = [
    ("OutdoorHub", r"outdoor[\s\-]*hub"),
    ("HomeNest", r"home[\s\-]*nest"),
    ("GardenPlus", r"garden[\s\-\+]*plus"),
    ("NatureGoods", r"nature[\s\-]*goods"),
    ("PatioWorld", r"patio[\s\-_!]*world"),
]

# Exact status synonyms on the trimmed lower-case text.
STATUS_SYNONYMS = [
    ("Shipped", ["shipped", "dispatched", "in transit"]),
    ("Processing", ["processing", "pending", "in progress"]),
    ("Delivered", ["delivered", "complete", "completed"]),
    ("Returned", ["returned", "refunded", "refund"]),
    ("Cancelled", ["cancelled", "canceled"]),
]

# Statuses that do not count as sales.
NON_SALES_STATUSES = ["Returned", "Cancelled"]

# Revenue tolerance and outlier bounds in USD.
REVENUE_TOLERANCE = Decimal("0.02")
REVENUE_LOW = Decimal("0.01")
REVENUE_HIGH = Decimal("5000")

# Rejected share in percent below which a run is healthy / a warning.
HEALTHY_BELOW = 5
WARNING_BELOW = 10

# Landing conventions.
SUBJECT_FILTER = "[E-Com] Daily Sales Export"
SUBJECT_PATTERN = r"^\[E-Com\] Daily Sales Export\s*[–-]\s*\d{4}-\d{2}-\d{2}$"
FILE_PATTERN = r"^e_com_sales_\d{8}\.csv$"
SUBJECT_DAY = r"(\d{4}-\d{2}-\d{2})$"
FILE_DAY = r"e_com_sales_(\d{8})\.csv$"

# The words a read-only text may not contain.
FORBIDDEN_WORDS = ["INSERT", "UPDATE", "DELETE", "DROP", "CREATE", "ALTER", "TRUNCATE", "MERGE", "CALL"]

# Id, severity, name and description of each data-quality check.
CHECKS = [
    ("C1", "CRITICAL", "Empty batch",
     "No rows found for todays ingestion batch. File may be missing or empty."),
    ("C2", "CRITICAL", "Null order_id",
     "Rows missing order_id cannot be tracked, deduplicated or linked to customers."),
    ("C3", "CRITICAL", "Null order_date",
     "Rows with null order_date cannot be partitioned or used in time-series analysis."),
    ("C4", "CRITICAL", "Future-dated orders",
     "Orders dated beyond today indicate clock skew or source system corruption."),
    ("C5", "CRITICAL", "Null revenue",
     "Rows with null revenue cannot contribute to any financial reporting."),
    ("W1", "WARNING", "Exact duplicate rows",
     "Identical rows across all columns — source system likely double-sent the file."),
    ("W2", "WARNING", "Conflicting order_id duplicates",
     "Same order_id appears multiple times with different values — retry/resend bug in source."),
    ("W3", "WARNING", "Negative quantity",
     "Negative quantities indicate data-entry errors or unprocessed returns."),
    ("W4", "WARNING", "Zero quantity",
     "Orders with zero quantity generate no revenue and should not exist."),
    ("W5", "WARNING", "Revenue mismatch (revenue ≠ qty × price - discount)",
     "Revenue does not match expected calculation — source system computation bug."),
    ("W6", "WARNING", "Outlier revenue values",
     "Revenue ≤ $0.01 or > $5,000 per row — likely decimal point error in source."),
    ("W7", "WARNING", "Invalid customer_state codes",
     "State codes not matching valid US 2-letter codes — bad validation at entry point."),
    ("I1", "INFO", "Null customer_email",
     "Expected for guest checkouts. High rates may indicate a collection issue."),
    ("I2", "INFO", "Malformed customer_email (missing @)",
     "Email address does not contain @ — frontend validation gap."),
    ("I3", "INFO", "Null customer_name",
     "Expected for guest checkouts. Monitor for unexpected spikes."),
    ("I4", "INFO", "Null shipping_method",
     "Shipping method not captured — may be store pickup or system gap."),
    ("I5", "INFO", "Null payment_method",
     "Payment method not captured for some orders."),
    ("I6", "INFO", "Inconsistent store_name values",
     "Store names have casing/spacing variants — normalisation needed in staging."),
]
