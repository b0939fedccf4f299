"""Relational operators the models and checks are composed from."""
