"""Operators for preparing large text corpora: de-duplication, filtering, scoring, mixing."""
