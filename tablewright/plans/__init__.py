"""Multi-step jobs over table sets and databases."""
