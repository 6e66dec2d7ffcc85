"""Tables and CSV exports."""
