"""Services that stand in for a network in the catalog's queries: vectors by hashing, and what can go wrong."""

from __future__ import annotations

import hashlib
from functools import partial

from loomvec.operators import providers

DIMS = 16
Hashing = partial(providers.HashingProvider, DIMS)


class SomeTextsFail:
    """Hashing that raises for a text's first tries, as often as its MD5 says (0 to 4)."""

    def __init__(self):
        self.inner = Hashing()
        self.tries: dict[str, int] = {}

    def embed(self, texts, endpoint=None):
        key = "\n".join(texts)
        # A batch gets three tries; copies of it start over.
        tried = self.tries[key] = self.tries.get(key, 0) % 3 + 1
        if tried <= int(hashlib.md5(key.encode()).hexdigest()[0], 16) % 5:
            raise ConnectionError("no answer")
        del self.tries[key]
        return self.inner.embed(texts)


class SomeAnswersShort:
    """Hashing that leaves out the vector of texts whose MD5 starts with an even digit."""

    def __init__(self):
        self.inner = Hashing()

    def embed(self, texts, endpoint=None):
        vectors = self.inner.embed(texts)
        kept = [i for i, t in enumerate(texts) if int(hashlib.md5(t.encode()).hexdigest()[0], 16) % 2]
        return vectors[kept]


class Answering:
    """Stands in for the network: answers a request body in one of the response shapes."""

    def __init__(self, shape: str):
        self.shape = shape
        self.inner = Hashing()

    def __call__(self, url, body, headers, timeout):
        vectors = self.inner.embed(body["inputs"] if "inputs" in body else body["text"]).tolist()
        if self.shape == "nested":
            return [[v] for v in vectors]
        return {"embeddings": vectors} if self.shape == "keyed" else vectors
