"""Composed plans: the fixture pipeline, evaluation, and plan inspection."""
