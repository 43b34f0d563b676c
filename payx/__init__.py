"""payx: Spark-native measurement of machine-initiated stablecoin payments."""
