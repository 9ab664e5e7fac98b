"""Monthly snapshot data mart on Spark: cleaned tables, labels, features, quality."""
