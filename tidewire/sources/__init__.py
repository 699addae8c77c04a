"""Readers of landed data and writers of stage and feature tables."""
