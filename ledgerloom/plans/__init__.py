"""The jobs: cleansing, customer history, facts, features, drift, reports, the monthly run."""
