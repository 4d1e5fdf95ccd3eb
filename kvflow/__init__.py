"""kvflow: PySpark-native analysis, transformation and movement of key-value command data."""
