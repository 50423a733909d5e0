"""Operators of a training-data pipeline (see README, "Training-data operators").

Nothing outside this subpackage imports it.
"""
