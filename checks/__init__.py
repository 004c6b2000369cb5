"""Registered queries: input views, stage frames, and the same results as SQL text."""
