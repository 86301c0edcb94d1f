"""Registered plans: each query reads the driver tables and composes operators; ``oracle`` holds the SQL twin."""
