"""Parameters and fixed values of the business rules."""

from __future__ import annotations

# --- Fixed values (must equal the reference's business rules) -------------------
# Stock codes that are service charges, not catalogue products.
SERVICE_CODES = ["POST", "DOT", "M", "C2", "D", "S", "BANK CHARGES"]
# A stock code is a product only if it starts with a digit.
PRODUCT_CODE_PATTERN = r"^\d"
# Invoice numbers of returns start with this prefix.
RETURN_PREFIX = "C"
# Country value that the cleaning drops (nulls are kept).
UNSPECIFIED_COUNTRY = "Unspecified"
# Weekdays reported by the exploratory weekday chart, in display order (no Saturday).
REPORTED_WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Sunday"]
# Country label of the guest member of the customer dimension.
GUEST_COUNTRY = "Unknown"
# RFM segments, first matching rule wins (r, f, m are NTILE(5) scores, 5 = best).
SEGMENT_CHAMPIONS = "Champions"
SEGMENT_LOYAL = "Loyal customers"
SEGMENT_NEW = "New customers"
SEGMENT_AT_RISK = "At risk"
SEGMENT_LOST = "Lost"
SEGMENT_POTENTIAL = "Potential loyalists"
# Pareto threshold (percent of revenue) and the wider plotting window.
PARETO_PCT = 80
PARETO_PLOT_PCT = 85
# Minimum number of orders for a country to be reported by the country query.
MIN_COUNTRY_ORDERS = 10
# --------------------------------------------------------------------------------

# Sentinel customer id for guest (anonymous) orders in the star schema.  The
# reference uses 0; the synthetic test tables have a real customer with key 0,
# so the sentinel is -1 to keep the customer key unique.
GUEST_ID = -1

# Order priority that marks a guest order in the synthetic test tables.
GUEST_PRIORITY = "4-NOT SPECIFIED"

# Default country selection of the dashboard on the synthetic tables (the dashboard
# starts with five markets selected and all years).
DASHBOARD_COUNTRIES = [f"NATION_{i}" for i in range(5)]

# Home market of the synthetic tables (first nation by name) and RFM reference date.
HOME_COUNTRY = "NATION_0"
RFM_REFERENCE_DATE = "2001-08-01 00:00:00"

# Churn model (described by the reference without code; these are our definitions):
# features from purchases before the cutoff, label = no purchase in the following
# horizon; a retention incentive costs INCENTIVE_COST and keeps RETENTION_SUCCESS of
# the customers it reaches, each worth their revenue of the year before the cutoff.
CHURN_CUTOFF = "2000-08-01 00:00:00"
CHURN_HORIZON_DAYS = 365
CHURN_INCENTIVE_COST = 100.0
CHURN_RETENTION_SUCCESS = 0.3
CHURN_THRESHOLD = 0.5
CHURN_SEED = 42
# Boosted churn model: trees, levels of a tree, bins of a feature, shrinkage of a tree.
CHURN_ROUNDS = 10
CHURN_DEPTH = 3
CHURN_BINS = 16
CHURN_RATE = 0.3
