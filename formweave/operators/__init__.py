"""DataFrame-to-DataFrame steps of the form jobs."""
