"""Operators put together: the selection funnel and the loan preparation chain."""
