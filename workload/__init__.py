"""Queries over the driver tables: booking-shaped views, registered queries, and their SQL twins."""
