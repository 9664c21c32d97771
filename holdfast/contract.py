"""Column contracts and business constants.

One place states what the customer and telemetry feeds must look like; all
operators take these values as default parameters.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Feed headers, domains, ranges and bands that results depend on
# --------------------------------------------------------------------------

# raw header -> conformed name, in feed order
RAW_TO_CONFORMED = {
    "customerID": "customer_id",
    "gender": "gender",
    "SeniorCitizen": "senior_citizen",
    "Partner": "partner",
    "Dependents": "dependents",
    "tenure": "tenure_months",
    "PhoneService": "phone_service",
    "MultipleLines": "multiple_lines",
    "InternetService": "internet_service",
    "OnlineSecurity": "online_security",
    "OnlineBackup": "online_backup",
    "DeviceProtection": "device_protection",
    "TechSupport": "tech_support",
    "StreamingTV": "streaming_tv",
    "StreamingMovies": "streaming_movies",
    "Contract": "contract",
    "PaperlessBilling": "paperless_billing",
    "PaymentMethod": "payment_method",
    "MonthlyCharges": "monthly_charges",
    "TotalCharges": "total_charges",
    "Churn": "churn",
}
RAW_COLUMNS = list(RAW_TO_CONFORMED)

TELEMETRY_COLUMNS = [
    "customer_id", "month", "month_index", "dropped_call_pct", "avg_download_mbps",
    "avg_latency_ms", "outage_minutes", "data_usage_gb", "complaints",
]

ADDONS = [
    "online_security", "online_backup", "device_protection",
    "tech_support", "streaming_tv", "streaming_movies",
]

_YES_NO = ("No", "Yes")
_ADDON = ("No", "No internet service", "Yes")
DOMAINS: dict[str, tuple[str, ...]] = {
    "gender": ("Female", "Male"),
    "senior_citizen": _YES_NO,
    "partner": _YES_NO,
    "dependents": _YES_NO,
    "phone_service": _YES_NO,
    "multiple_lines": ("No", "No phone service", "Yes"),
    "internet_service": ("DSL", "Fiber optic", "No"),
    **{c: _ADDON for c in ADDONS},
    "contract": ("Month-to-month", "One year", "Two year"),
    "paperless_billing": _YES_NO,
    "payment_method": ("Bank transfer (automatic)", "Credit card (automatic)",
                       "Electronic check", "Mailed check"),
    "churn": _YES_NO,
}

RANGES: dict[str, tuple[int, int]] = {
    "tenure_months": (0, 72),
    "monthly_charges": (0, 200),
    "total_charges": (0, 15000),
    "dropped_call_pct": (0, 100),
    "avg_download_mbps": (0, 2000),
    "avg_latency_ms": (0, 1000),
    "outage_minutes": (0, 44640),
    "data_usage_gb": (0, 5000),
    "complaints": (0, 100),
}

TENURE_BUCKETS = [(0, 12, "00-12 months"), (13, 24, "13-24 months"),
                  (25, 48, "25-48 months"), (49, 72, "49-72 months")]
RISK_BANDS = [(0.0, 0.2, "Low"), (0.2, 0.5, "Medium"), (0.5, 1.01, "High")]
REVENUE_BANDS = ["Low", "Mid", "High", "Premium"]
QUALITY_BANDS = [(55.0, "Poor"), (70.0, "Fair"), (82.0, "Good"), (100.1, "Excellent")]
NO_TELEMETRY = "No telemetry"

WINDOW_MONTHS = 12
RECENT_MONTHS = 3

# component -> (lower bound, upper bound, higher is better)
QUALITY_COMPONENTS = {
    "avg_dropped_call_pct": (0.0, 3.0, False),
    "latency_ratio": (0.6, 2.0, False),
    "speed_ratio": (0.5, 1.2, True),
    "total_outage_minutes": (0.0, 400.0, False),
    "network_complaints": (0.0, 4.0, False),
}

# decimal places that count in sums: sums over these columns run on whole units of the
# last place, so they do not depend on row order or partitioning; bigint sums hold for
# 10^12 rows. Telemetry has no declared places: it is summed as it was read.
DECIMALS: dict[str, int] = {
    "monthly_charges": 2, "total_charges": 2, "lifetime_avg_monthly": 2, "charge_ratio": 3,
    "network_complaints": 0, "l3m_complaints": 0, "dropped_call_trend_pp": 3, "latency_trend_pct": 1, "download_trend_pct": 1,
    "network_quality_score": 1, "churn_probability": 4, "tenure_months": 0,
    "num_addon_services": 0, "churn_flag": 0,
}

CUSTOMER_DIM = ["customer_id", "gender", "senior_citizen", "partner", "dependents",
                "tenure_months", "tenure_bucket"]
CONTRACT_DIM = ["contract", "paperless_billing", "payment_method", "is_auto_payment"]
SERVICES_DIM = ["phone_service", "multiple_lines", "internet_service", *ADDONS,
                "num_addon_services", "has_internet", "has_phone", "has_streaming"]
# measure of the customer fact -> Spark type used when a feature was not computed
FACT_MEASURES = {
    "monthly_charges": "double", "total_charges": "double", "lifetime_avg_monthly": "double",
    "charge_ratio": "double", "revenue_band": "string", "churn": "string", "churn_flag": "int",
    "kpi_months": "bigint", "avg_dropped_call_pct": "double", "avg_download_mbps": "double",
    "avg_latency_ms": "double", "total_outage_minutes": "bigint", "avg_data_usage_gb": "double",
    "network_complaints": "bigint", "l3m_dropped_call_pct": "double",
    "l3m_download_mbps": "double", "l3m_latency_ms": "double", "l3m_outage_minutes": "bigint",
    "l3m_complaints": "bigint", "dropped_call_trend_pp": "double", "latency_trend_pct": "double",
    "download_trend_pct": "double", "network_quality_score": "double",
    "network_quality_band": "string", "churn_probability": "double", "risk_band": "string",
}

# model inputs
CATEGORICAL_FEATURES = [
    "gender", "senior_citizen", "partner", "dependents", "phone_service", "multiple_lines",
    "internet_service", *ADDONS, "contract", "paperless_billing", "payment_method",
]
CUSTOMER_NUMERICS = ["tenure_months", "monthly_charges", "total_charges",
                     "num_addon_services", "charge_ratio"]
NETWORK_NUMERICS = ["avg_dropped_call_pct", "avg_latency_ms", "avg_download_mbps",
                    "total_outage_minutes", "network_complaints", "network_quality_score",
                    "dropped_call_trend_pp", "latency_trend_pct", "l3m_complaints"]
FEATURE_SETS = {"customer": CUSTOMER_NUMERICS,
                "customer_network": CUSTOMER_NUMERICS + NETWORK_NUMERICS}

# declared column types of the typed bulk load, per star table
TYPED_LOAD: dict[str, dict[str, str]] = {
    "dim_customer": {
        "customer_key": "bigint", "customer_id": "string", "gender": "string",
        "senior_citizen": "string", "partner": "string", "dependents": "string",
        "tenure_months": "int", "tenure_bucket": "string",
    },
    "dim_contract": {
        "contract_key": "bigint", "contract": "string", "paperless_billing": "string",
        "payment_method": "string", "is_auto_payment": "int",
    },
    "dim_services": {
        "services_key": "bigint", "phone_service": "string", "multiple_lines": "string",
        "internet_service": "string", **{c: "string" for c in ADDONS},
        "num_addon_services": "int", "has_internet": "int", "has_phone": "int",
        "has_streaming": "int",
    },
    "dim_date": {
        "month_key": "int", "month": "string", "year": "int", "month_number": "int",
        "month_name": "string", "quarter": "string", "month_start_date": "date",
        "month_index": "bigint", "months_before_snapshot": "bigint",
    },
    "fact_customer": {
        "customer_key": "bigint", "contract_key": "bigint", "services_key": "bigint",
        "customer_id": "string", "monthly_charges": "decimal(9,2)",
        "total_charges": "decimal(11,2)", "lifetime_avg_monthly": "decimal(9,2)",
        "charge_ratio": "decimal(9,3)", "revenue_band": "string", "churn": "string",
        "churn_flag": "int", "kpi_months": "int", "avg_dropped_call_pct": "decimal(9,3)",
        "avg_download_mbps": "decimal(9,2)", "avg_latency_ms": "decimal(9,2)",
        "total_outage_minutes": "decimal(12,3)", "avg_data_usage_gb": "decimal(9,2)",
        "network_complaints": "int", "l3m_dropped_call_pct": "decimal(9,3)",
        "l3m_download_mbps": "decimal(9,2)", "l3m_latency_ms": "decimal(9,2)",
        "l3m_outage_minutes": "decimal(12,3)", "l3m_complaints": "int",
        "dropped_call_trend_pp": "decimal(9,3)", "latency_trend_pct": "decimal(9,1)",
        "download_trend_pct": "decimal(9,1)", "network_quality_score": "decimal(5,1)",
        "network_quality_band": "string", "churn_probability": "decimal(6,4)",
        "risk_band": "string",
    },
    "fact_network_monthly": {
        "customer_key": "bigint", "month_key": "int", "customer_id": "string",
        "month": "string", "month_index": "int", "dropped_call_pct": "decimal(9,3)",
        "avg_download_mbps": "decimal(9,1)", "avg_latency_ms": "decimal(9,1)",
        "outage_minutes": "decimal(12,3)", "data_usage_gb": "decimal(9,1)", "complaints": "int",
    },
    "dq_results": {
        "run_ts": "string", "check_name": "string", "table": "string", "status": "string",
        "observed": "string", "expectation": "string", "details": "string",
    },
}
# value of a blank cell on a typed load
LOAD_DEFAULTS: dict[str, dict[str, int]] = {"fact_customer": {"kpi_months": 0}}
# --------------------------------------------------------------------------
# end of fixed values
# --------------------------------------------------------------------------


class SchemaError(ValueError):
    """A feed lacks columns its contract requires."""


@dataclass(frozen=True)
class FeedContract:
    """What a feed must contain: ordered columns, domains, ranges and key."""

    name: str
    columns: list[str]
    key: list[str]
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)


CUSTOMER_FEED = FeedContract(
    "customers", RAW_COLUMNS, ["customer_id"], DOMAINS,
    {c: RANGES[c] for c in ("tenure_months", "monthly_charges", "total_charges")},
)
TELEMETRY_FEED = FeedContract(
    "network_kpis_monthly", TELEMETRY_COLUMNS, ["customer_id", "month"], {},
    {c: RANGES[c] for c in ("dropped_call_pct", "avg_download_mbps", "avg_latency_ms",
                            "outage_minutes", "data_usage_gb", "complaints")},
)
