"""Tracewright: curation of agent execution logs as composable Spark DataFrame functions."""
