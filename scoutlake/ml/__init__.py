"""Gradient-boosted models on the star schema."""
