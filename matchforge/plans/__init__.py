"""Marts, ranked views and decision reports over the participant fact."""
