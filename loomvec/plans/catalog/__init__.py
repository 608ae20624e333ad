"""Every operator as a query over the given tables, with the SQL it has to agree with."""

from loomvec.plans.catalog import embedding, records, requests, shards, streams, texts, vectors
from loomvec.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "embedding", "records", "requests", "shards", "streams", "texts", "vectors"]
