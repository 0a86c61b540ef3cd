"""End-to-end plans: the two corpus plans and the driver-table queries."""
