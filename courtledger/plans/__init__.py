"""Whole jobs built from the operators: pages in, stored tables out."""
