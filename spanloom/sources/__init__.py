"""Readers and writers of messages, records and segments."""
