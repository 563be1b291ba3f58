"""Fixed values.

These must equal the product's published enumerations and statistical conventions for
results to agree; they are stated here once, in their natural order.
"""

# --- fixed values: accepted event names (staging contract) ---
EVENT_NAMES = (
    "signup",
    "onboarding_started",
    "onboarding_completed",
    "first_project_created",
    "teammate_invited",
    "session_started",
    "feature_analytics_viewed",
    "feature_collab_used",
    "feature_export_used",
    "subscription_payment",
    "churned",
)

# --- fixed values: accepted user attributes and variants ---
PLANS = ("free", "pro", "team", "enterprise")
CHANNELS = ("organic", "paid_search", "linkedin_ads", "referral", "direct")
VARIANTS = ("control", "treatment")
CONTROL = "control"
TREATMENT = "treatment"

# --- fixed values: default activation funnel, in order ---
DEFAULT_FUNNEL_STEPS = (
    "signup",
    "onboarding_started",
    "onboarding_completed",
    "first_project_created",
    "teammate_invited",
)

# --- fixed values: event roles used by the models ---
SESSION_EVENT = "session_started"
PAYMENT_EVENT = "subscription_payment"
CHURN_EVENT = "churned"
FEATURE_PREFIX = "feature_"
CONVERSION_EVENTS = ("onboarding_completed", "first_project_created")

# --- fixed values: default as-of instant of the activity model (UTC) ---
DEFAULT_AS_OF = "2026-07-26 00:00:00"

# --- fixed values: experiment statistics ---
DEFAULT_ALPHA = 0.05
POWER = 0.8
RECOMMEND_SHIP = "Ship treatment: statistically significant uplift detected."
RECOMMEND_STOP = "Do not ship: treatment significantly underperforms control."
RECOMMEND_CONTINUE = "No significant effect: continue test or increase sample size."

# --- fixed values: churn model ---
CHURN_FEATURES = ("session_count", "feature_events", "days_since_active", "revenue_total")
CHURN_TEST_SHARE = 0.25
CHURN_SEED = 42

# --- fixed values: texts of checks and errors ---
GATE_FAILED = "Warehouse verification failed"
MISSING_COLUMNS = "is missing columns"
PUBLISHED_ELSEWHERE = "was published by another run meanwhile"
DUPLICATE_KEYS = "contains duplicate key values for"
NULL_KEYS = "has NULL values in NOT NULL columns"
NO_DROPOFF = "Not enough data for drop-off analysis"
CHECK_EVENTS = "staging_event_count_matches_source"
CHECK_USERS = "staging_user_count_matches_source"
CHECK_ASSIGNMENTS = "assignment_mart_matches_source"
CHECK_FUNNEL = "funnel_has_five_rows_per_user"
CHECK_COHORT = "cohort_mart_is_not_empty"
CHECK_ENGAGEMENT = "engagement_mart_is_not_empty"
