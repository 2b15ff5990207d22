"""Readers that turn dumped metadata responses into tables."""
