"""Spark table operators for market-price and daily-weather analytics."""
