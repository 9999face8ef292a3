"""Spark-native discovery of strand-aware cleavage sites in aligned reads."""
