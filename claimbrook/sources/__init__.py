"""Where claims data comes from and goes to: deliveries, archives, the Parquet lake."""
