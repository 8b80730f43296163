"""End-to-end plans and where they keep intermediate tables."""
