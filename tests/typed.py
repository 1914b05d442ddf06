"""Column types that several test modules build tables with."""

SUBSCRIPTION_TYPES = (
    "row_id BIGINT, customer_id STRING, start_date DATE, end_date DATE, plan STRING, monthly_price DECIMAL(28,6)"
)
