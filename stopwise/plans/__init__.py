"""Multi-step plans: decorators, the bronze/silver pipeline and the dashboards."""
