"""The job: attribution fact, conversion rows and the daily delivery run."""
