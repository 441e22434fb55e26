"""Layer builders, report views and the end-to-end run."""
