"""Report plans: the 21 report queries, calendar and report mart."""
