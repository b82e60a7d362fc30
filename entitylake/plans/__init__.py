"""Composites: extraction into a page lake, counts report, attribute dictionary."""
