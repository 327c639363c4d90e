"""Inputs and outputs: staging files, calendar, report documents, the published tables."""
