"""Operators: functions from DataFrame to DataFrame, and ML stages."""
