"""Column-level cleaning, features and scores."""
