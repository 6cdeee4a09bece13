"""Readers, writers and the derivation of the sensor fixtures from the driver tables."""
