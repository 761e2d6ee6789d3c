"""Flows and batches built from the operators."""
