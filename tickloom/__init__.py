"""Tick-trade lake on PySpark: decode, candles, maintenance, checks, serving."""
