"""Readers and writers of trip tables, logs, reports and fixtures."""
