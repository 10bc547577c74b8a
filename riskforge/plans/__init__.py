"""Execution plans: join strategy helpers, materialization and the full run."""
