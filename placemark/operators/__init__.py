"""Relational operators: matching, change detection, lifecycle, discovery."""
