"""Operators: functions from frames (or graphs of frames) to frames."""
