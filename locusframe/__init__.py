"""Sequencing-evidence analytics as plain PySpark DataFrame functions."""
