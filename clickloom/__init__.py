"""clickloom: an e-commerce clickstream pipeline written for Spark.

Monthly CSV batches become a day-partitioned event history, cleaned and de-duplicated events, a star schema with an
incrementally merged fact, data-quality checks and three reports.
"""
