"""Test inputs: flight-shaped views derived from the TPC-H-like test tables."""
