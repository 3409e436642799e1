"""Operators for training-data preparation; nothing outside this folder imports them except the guarded entry points."""
