"""Registered queries over the driver's test tables (see ``queries``)."""
