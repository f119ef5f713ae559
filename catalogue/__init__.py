"""Registered queries and their SQL counterparts."""
from catalogue import builders, common, curation, extraction, geography, labels, layers, reports
def all_queries():
    return dict(common.QUERIES)
def all_sql():
    return dict(common.SQL)
