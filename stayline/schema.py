"""Fixed values of the customer table: columns, domains, thresholds."""

from pyspark.sql import types as T

ID = "customerID"
TARGET = "Churn"

SERVICES = [
    "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies",
]

YES_NO = ["Yes", "No"]
WITH_PHONE = ["Yes", "No", "No phone service"]
WITH_INTERNET = ["Yes", "No", "No internet service"]
CONTRACTS = ["Month-to-month", "One year", "Two year"]
PAYMENT_METHODS = [
    "Electronic check", "Mailed check",
    "Bank transfer (automatic)", "Credit card (automatic)",
]

# Allowed values per column.
DOMAINS = {
    "gender": ["Male", "Female"],
    "Partner": YES_NO,
    "Dependents": YES_NO,
    "PhoneService": YES_NO,
    "MultipleLines": WITH_PHONE,
    "InternetService": ["DSL", "Fiber optic", "No"],
    **{c: WITH_INTERNET for c in SERVICES},
    "Contract": CONTRACTS,
    "PaperlessBilling": YES_NO,
    "PaymentMethod": PAYMENT_METHODS,
}

NUMERIC = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"]
CATEGORICAL = list(DOMAINS)

CUSTOMER_COLUMNS = [
    ID, "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", *SERVICES,
    "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", TARGET,
]

_TYPES = {
    "SeniorCitizen": T.IntegerType(),
    "tenure": T.IntegerType(),
    "MonthlyCharges": T.DoubleType(),
    "TotalCharges": T.DoubleType(),
}

CUSTOMERS = T.StructType(
    [T.StructField(c, _TYPES.get(c, T.StringType())) for c in CUSTOMER_COLUMNS]
)

# TotalCharges is text in the raw file: it holds blanks.
RAW_CUSTOMERS = T.StructType(
    [
        T.StructField(c, T.StringType() if c == "TotalCharges" else _TYPES.get(c, T.StringType()))
        for c in CUSTOMER_COLUMNS
    ]
)

PREDICTIONS = T.StructType(
    [T.StructField(ID, T.StringType()), T.StructField("churn_probability", T.DoubleType())]
)

# Values an event takes where it leaves the field out.
EVENT_DEFAULTS = {
    "gender": "Male",
    "SeniorCitizen": 0,
    "Partner": "No",
    "Dependents": "No",
    "tenure": 0,
    "PhoneService": "No",
    "MultipleLines": "No",
    "InternetService": "No",
    **{c: "No" for c in SERVICES},
    "Contract": "Month-to-month",
    "PaperlessBilling": "No",
    "PaymentMethod": "Electronic check",
    "MonthlyCharges": 0.0,
}

RISK_LEVELS = ["critical", "high", "medium", "low"]
SEGMENTS = ["vip", "loyal", "growing", "at_risk", "new", "disengaged"]
JOURNEY_STAGES = ["acquisition", "onboarding", "growth", "maturity", "retention", "at_risk"]
SEVERITIES = ["none", "low", "medium", "high"]

TIMESTAMP_PATTERN = "yyyyMMdd'T'HHmmss'Z'"
