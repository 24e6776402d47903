"""The data model: staging, star schema, KPI tables, reports and governance."""
