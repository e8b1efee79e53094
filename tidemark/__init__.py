"""Spark-native e-commerce lakehouse analytics: CDC, clickstream, star schema, dashboards."""
