"""Operators for preparing training corpora; see the README section of the same name."""
