"""Readers: messages, requests, rules and table metadata."""
