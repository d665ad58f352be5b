"""Equity signals as Spark jobs: price bars, news sentiment and insider trades.

Landed feeds become keyed bronze tables, typed silver tables and analytical gold
tables; every step is a ``DataFrame -> DataFrame`` function that Catalyst plans.
"""
