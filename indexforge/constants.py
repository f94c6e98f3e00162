"""Fixed values that results depend on.

These must equal the values the original application writes and reads, so they
are stated here once, in plain text.
"""

# --- fixed values -----------------------------------------------------------
EQUAL_WEIGHTED = "Equal Weighted"
MARKET_CAP_WEIGHTED = "Market-Cap Weighted"
INDEX_TYPES = (EQUAL_WEIGHTED, MARKET_CAP_WEIGHTED)

DEFAULT_TOP_N = 100            # index size of the monolithic generation
SERVICE_TOP_N = 5              # index size of the service generation
DEFAULT_WINDOW_DAYS = 30       # default reporting window (days before as_of)
DEFAULT_PREVIEW_ROWS = 10      # preview helpers
DEFAULT_MISSING_BATCH = 50     # profiles fetched per missing-symbol batch
ROSTER_MARKET = "stocks"       # roster filter market=stocks, active=true
MEMBERSHIP_SEPARATOR = ","     # symbols list separator
MS_PER_DAY = 86_400_000
# ---------------------------------------------------------------------------
