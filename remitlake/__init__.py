"""Payment-transaction analytics on Spark: raw CSV -> bronze -> silver -> gold."""
