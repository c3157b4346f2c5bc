"""Registered queries, their SQL counterparts and offline jobs."""
