"""Column-level building blocks: buckets, labels, rates. All built-in Spark
expressions (codegen-friendly), no Python UDFs."""
