"""Shopper feature engine: interaction log in, scored user-merchant pairs out."""
