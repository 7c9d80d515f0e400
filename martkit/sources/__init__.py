"""Sources, sinks and table maintenance (S*)."""
