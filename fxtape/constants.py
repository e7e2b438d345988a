"""Names, labels, texts and patterns that results must carry as they are."""

# Stocks in scope: symbol, company name, currency, short display name.
STOCKS = [
    ("JPM", "JPMorgan Chase & Co.", "USD", "JPMorgan Chase"),
    ("BAC", "Bank of America Corporation", "USD", "Bank of America"),
    ("GS", "The Goldman Sachs Group, Inc.", "USD", "Goldman Sachs"),
    ("MS", "Morgan Stanley", "USD", "Morgan Stanley"),
]
SYMBOLS = [stock[0] for stock in STOCKS]
CURRENCY = "USD"

# Zones: local valuation dates and trading sessions.
LOCAL_ZONE = "Asia/Jakarta"
SESSION_ZONE = "America/New_York"

# Event contract.
SCHEMA_VERSION = 1
EVENT_SOURCE = "yfinance"
REPLAY_MODE = "replay"
LIVE_MODE = "live_websocket"
BAR_RECORD = "historical_bar"
TICK_RECORD = "price_update"
BAR_INTERVAL = "1m"
TICK_INTERVAL = "event"
FUTURE_TOLERANCE_SECONDS = 300
EARLIEST_YEAR = 2000

# Signals, their rule name and their explanations.
SIGNAL_RULE_VERSION = "sma_3_8_crossover_v1"
SIGNAL_TYPE = "SIMULATION_RULE_NOT_INVESTMENT_ADVICE"
SIGNALS = ["BUY", "SELL", "HOLD", "NO_SIGNAL"]
SIGNAL_REASONS = {
    "BUY": "SMA3 crosses above SMA8; simulated entry signal",
    "SELL": "SMA3 crosses below SMA8; simulated exit signal, not a short order",
    "HOLD": "No new crossover; no new action, not proof of an existing position",
    "NO_SIGNAL": "Insufficient consecutive history or unavailable FX",
}

# Signal scenarios: id, short, long, previous short, previous long, ready, expected.
SIGNAL_SCENARIOS = [
    ("cross_up", 101.0, 100.0, 99.0, 100.0, True, "BUY"),
    ("cross_down", 99.0, 100.0, 101.0, 100.0, True, "SELL"),
    ("trend_continues", 102.0, 100.0, 101.0, 100.0, True, "HOLD"),
    ("equal_averages", 100.0, 100.0, 100.0, 100.0, True, "HOLD"),
    ("missing_history", 101.0, 100.0, 99.0, 100.0, False, "NO_SIGNAL"),
]
SCENARIO_DATA_KIND = "synthetic_formula_fixture"

# Labels of the marts.
FX_POLICIES = ["missing_fx", "prior_day_assumption", "verified_availability"]
VALUATION_STATUSES = ["unavailable", "indicative_per_share"]
RISK_LABELS = ["insufficient_data", "review_movement", "within_demo_threshold"]
DATA_STATUSES = ["missing_fx", "insufficient_history", "ready"]
REPLAY_KIND = "real_historical_replay"
LIVE_KIND = "live_price_update"
COVERAGE_LABELS = [
    "duplicate",
    "available",
    "today_not_available_yet",
    "weekend_no_record",
    "weekday_missing_unverified",
]

# Run ids look like 20260909T214210877646Z.
RUN_ID_PATTERN = r"^\d{8}T\d{12}Z$"

# Tags of the exchange-rate document.
FX_ROW_TAG = "Table"
FX_DATE_TAG = "tgl_subkursasing"
FX_CURRENCY_TAG = "mts_subkursasing"
FX_RATE_TAG = "jual_subkursasing"
