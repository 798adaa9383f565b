"""Relational, grouped, keyed, changelog and learner operators."""
