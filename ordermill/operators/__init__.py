"""Operators: functions from DataFrame to DataFrame, lazy unless their text says otherwise."""
