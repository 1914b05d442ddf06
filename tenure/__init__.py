"""Subscription analytics as Spark plans.

Bronze tables (raw text) become a typed silver layer, every finding becomes a row of a
warnings table, and the silver layer feeds recurring revenue, churn and cohort retention.
Every public function takes DataFrames and returns DataFrames. Building a plan runs a job only
for the strict quality gate and where an intermediate is written once (operators/staging.py).
"""

from tenure.config import Settings
from tenure.errors import DataQualityError

__all__ = ["DataQualityError", "Settings"]
