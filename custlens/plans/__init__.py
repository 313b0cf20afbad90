"""End-to-end plans, registered queries and their oracle SQL."""
