"""Readers and writers: landing messages, test landings, delimited hand-off files."""
