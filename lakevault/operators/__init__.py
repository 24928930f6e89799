"""Vault modelling, merges, history, event contract and data-quality operators."""
