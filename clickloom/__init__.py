"""Retail behaviour and ad-click analytics as PySpark DataFrame programs."""
