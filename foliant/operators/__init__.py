"""Operators on bibliographic tables."""
