"""Names, thresholds, lists and labels that results must agree on."""

# --- commerce -------------------------------------------------------------------------

ORDER_STATUSES = [
    "delivered", "shipped", "canceled", "unavailable",
    "invoiced", "processing", "created", "approved",
]

PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]

# Macro-region -> states; the union of the lists is the set of valid states.
REGION_STATES = {
    "Sudeste": ["SP", "RJ", "MG", "ES"],
    "Sul": ["PR", "SC", "RS"],
    "Nordeste": ["BA", "PE", "CE", "MA", "PB", "RN", "AL", "SE", "PI"],
    "Centro-Oeste": ["DF", "GO", "MT", "MS"],
    "Norte": ["AM", "PA", "AC", "RO", "RR", "AP", "TO"],
}
UNKNOWN_REGION = "Desconhecido"

# Each segment: lowest/highest accepted score for recency, frequency, money. First hit wins.
RFM_SEGMENTS = [
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (3, 5)),
    ("New Customers", (4, 5), (1, 2), (1, 5)),
    ("Potential Loyalists", (3, 5), (1, 5), (3, 5)),
    ("At Risk", (1, 2), (3, 5), (3, 5)),
    ("Cannot Lose Them", (1, 2), (4, 5), (1, 5)),
    ("Lost", (1, 2), (1, 2), (1, 2)),
]
RFM_REMAINDER = "Others"

RFM_DASHBOARD_SEGMENTS = [
    ("Champions", (4, 5), (4, 5), (1, 5)),
    ("Loyal", (3, 5), (3, 5), (1, 5)),
    ("New", (3, 5), (1, 2), (1, 5)),
    ("At Risk", (1, 2), (3, 5), (1, 5)),
]
RFM_DASHBOARD_REMAINDER = "Hibernating"

SPEND_TIERS = ["Premium", "Regular", "Basic", "Low"]  # >= q3, >= q2, >= q1, rest
CHURN_DAYS = 90

# Required columns, foreign keys and ranges of the landed commerce tables.
REQUIRED_COLUMNS = {
    "orders": ["order_id", "customer_id", "order_status"],
    "order_items": ["order_id", "product_id", "seller_id"],
    "customers": ["customer_id", "customer_unique_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "payments": ["order_id", "payment_type"],
    "reviews": ["review_id", "order_id", "review_score"],
    "geolocation": ["geolocation_zip_code_prefix"],
    "category_translation": ["product_category_name", "product_category_name_english"],
}
FOREIGN_KEYS = [
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("reviews", "order_id", "orders", "order_id"),
    ("orders", "customer_id", "customers", "customer_id"),
]
ROW_COUNT_TOLERANCE_PCT = 5.0

# --- macro series ---------------------------------------------------------------------

# Series code -> column of the wide indicator table.
SERIES_COLUMNS = {
    "GDP": "gdp_current_dollars",
    "GDPC1": "gdp_real_chained",
    "GDPPOT": "gdp_potential",
    "CPIAUCSL": "cpi_all_urban",
    "CPILFESL": "cpi_less_food_energy",
    "PCEPI": "pce_price_index",
    "UNRATE": "unemployment_rate",
    "PAYEMS": "nonfarm_payroll",
    "CIVPART": "labor_force_participation",
    "FEDFUNDS": "federal_funds_rate",
    "DGS10": "treasury_10y_rate",
    "DGS2": "treasury_2y_rate",
    "T10Y2Y": "yield_curve_10y_2y",
    "M2SL": "m2_money_supply",
    "M1SL": "m1_money_supply",
    "BOGMBASE": "monetary_base",
}

SERIES_CATEGORIES = {
    "gdp": ["GDP", "GDPC1", "GDPPOT"],
    "inflation": ["CPIAUCSL", "CPILFESL", "PCEPI"],
    "employment": ["UNRATE", "PAYEMS", "CIVPART"],
    "interest_rates": ["FEDFUNDS", "DGS10", "DGS2", "T10Y2Y"],
    "money_supply": ["M2SL", "M1SL", "BOGMBASE"],
}

INDICATOR_PREFIXES = {
    "gdp": "NY.GDP",
    "inflation": "FP.CPI",
    "unemployment": "SL.UEM",
    "trade": "NE.TRD",
    "population": "SP.POP",
}

MAJOR_ECONOMIES = ["USA", "CHN", "JPN", "DEU", "GBR", "FRA", "IND", "ITA", "BRA", "CAN"]
G7 = ["USA", "JPN", "DEU", "GBR", "FRA", "ITA", "CAN"]
G20 = [
    "ARG", "AUS", "BRA", "CAN", "CHN", "DEU", "FRA", "GBR", "IDN", "IND",
    "ITA", "JPN", "KOR", "MEX", "RUS", "SAU", "TUR", "USA", "ZAF",
]

YIELD_TENORS = ["1m", "3m", "6m", "1y", "2y", "3y", "5y", "7y", "10y", "20y", "30y"]

SECURITY_TYPES = ["Treasury Bills", "Treasury Notes", "Treasury Bonds"]
MATURITY_SECURITY = {
    2: "Treasury Notes",
    5: "Treasury Notes",
    10: "Treasury Notes",
    30: "Treasury Bonds",
}

US_SUMMARY_SERIES = ["GDP", "UNRATE", "CPIAUCSL", "FEDFUNDS", "DGS10", "M2SL"]
OVERVIEW_SERIES = ["FEDFUNDS", "DGS10", "CPIAUCSL", "UNRATE", "SP500"]

# --- sentiment and returns ------------------------------------------------------------

# Highest value of each class, in order; the last class has no upper bound.
SENTIMENT_CLASSES = [
    (24, "Extreme Fear"),
    (49, "Fear"),
    (50, "Neutral"),
    (74, "Greed"),
    (None, "Extreme Greed"),
]
SENTIMENT_SIGNALS = [
    (20, "Strong Buy Signal"),
    (35, "Buy Signal"),
    (65, "Hold"),
    (80, "Sell Signal"),
    (None, "Strong Sell Signal"),
]
PERIOD_DAYS = {"1m": 30, "3m": 90, "6m": 180, "1y": 365, "3y": 1095, "5y": 1825}

# --- formats --------------------------------------------------------------------------

# Accepted date formats, tried in this order.
DATE_FORMATS = [
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    "yyyy/MM/dd",
    "dd-MM-yyyy",
    "dd/MM/yyyy",
    "MM/dd/yyyy",
]
