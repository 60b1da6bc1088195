"""Writers. Every one overwrites its own batch's folder, so a replayed batch leaves no duplicates."""
