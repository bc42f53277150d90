"""Event-log tables on Spark: raw JSON to cleaned events, daily indicators, sessions and history."""
