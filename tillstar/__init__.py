"""Retail sales star schema on Spark: clean, load incrementally, analyse."""
