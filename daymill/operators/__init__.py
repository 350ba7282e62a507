"""Warehouse operators: functions from DataFrame to DataFrame, without actions."""
