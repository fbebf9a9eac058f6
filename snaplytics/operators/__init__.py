"""Relational operators: ``DataFrame -> DataFrame`` building blocks of the jobs."""
