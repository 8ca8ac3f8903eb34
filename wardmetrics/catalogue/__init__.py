"""Queries over the star-schema test tables, each with its ANSI SQL twin."""

from wardmetrics.catalogue import cells, domains, events, keys, loads, places, rules
from wardmetrics.catalogue.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "cells", "domains", "events", "keys", "loads", "places", "rules"]
