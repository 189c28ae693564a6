"""touchtrail: marketing-touch attribution and revenue analytics as Spark DataFrame operators."""
