"""Whole analyses: over the trace tables (`jobs`) and over the test tables (`tables`)."""
