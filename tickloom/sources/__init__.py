"""Inputs and outputs: wire messages, topics, stored tables."""
