"""Daily match-feed ETL on Spark: JSON replies in, flat date-partitioned tables out."""
