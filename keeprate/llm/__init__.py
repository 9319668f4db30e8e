"""Operators for training-data pipelines; registered queries are in ``keeprate.llm.queries``."""
