"""Chat-case analytics on Spark: messages in, case metrics, audits and reports out."""
