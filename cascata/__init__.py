"""Medallion analytics for learning content, written as Spark DataFrame jobs."""
