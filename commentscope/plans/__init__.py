"""Multi-step plans: mergeable summaries and the full run of all reports."""
