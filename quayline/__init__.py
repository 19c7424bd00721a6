"""A change-fed freight data warehouse on PySpark: change events, wide tables, daily KPI tables."""
