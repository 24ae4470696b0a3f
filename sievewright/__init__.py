"""Sievewright: a PySpark-native engine that curates text records for supervised classification."""
