"""Inputs: the message log, Kafka options, text files."""
