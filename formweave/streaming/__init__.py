"""The continuous job."""
