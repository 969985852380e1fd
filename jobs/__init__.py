"""Runnable jobs: each is a function of a session and settings, and a command line around it."""
