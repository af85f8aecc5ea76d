"""Warehouse plans: calendars, dimensions, facts, named views, and the registered queries."""
