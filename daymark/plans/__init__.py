"""What users run: the reports, and the daily runs that fill the zones."""
