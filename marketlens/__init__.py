"""Spark-native analytics for rental marketplaces: listings, calendars and reviews."""
