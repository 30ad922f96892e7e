"""obsflow: a PySpark-native engine for time-stamped observations."""
