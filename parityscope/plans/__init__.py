"""Whole audits put together from the operators."""
