"""Link-quality scoring on Spark: heartbeats in, per-line scores and categories out."""
