"""Operators put together: the trip tables, and the job that refreshes them."""
