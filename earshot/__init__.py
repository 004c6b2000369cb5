"""Earshot: open-text feedback analytics as Spark DataFrame operators."""
