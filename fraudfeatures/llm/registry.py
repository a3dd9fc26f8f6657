"""The queries of this subpackage, and their SQL where SQL can express them."""

from . import chat, codes, decontam, embdup, importance, langid, neardup, packing, quality, sharding, topk, toxicity, urls

MODULES = (neardup, sharding, urls, langid, chat, topk, toxicity, packing, decontam, quality, importance, codes, embdup)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
