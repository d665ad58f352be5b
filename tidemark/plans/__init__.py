"""The silver and gold tables, their quality checks and the analysis datasets."""
