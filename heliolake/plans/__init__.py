"""End-to-end plans: the daily / history pipeline and the driver-table queries."""
