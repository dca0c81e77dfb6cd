"""Operators: functions from frames and configuration to frames, without actions."""
