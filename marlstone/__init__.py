"""Spark-first analytics for financial-report pages, trade books and text corpora."""
