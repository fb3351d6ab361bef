"""Queries put together from the steps: scraping a list of sites, and reporting on the runs."""
