"""Embedding providers: what turns a list of texts into a list of vectors.

A provider is created once per task from a picklable factory and has

    embed(texts: list[str], endpoint: str | None) -> list[list[float]] | numpy.ndarray

Raising makes the attempt count as failed.
"""

from __future__ import annotations

import hashlib
import http.client
import json
import threading
from collections.abc import Callable, Sequence
from itertools import chain
from typing import Any, Protocol
from urllib.parse import urlsplit

import numpy as np

from loomvec.functions.vectors import EPSILON


class Provider(Protocol):
    def embed(self, texts: list[str], endpoint: str | None) -> Any: ...


class _Slots(dict):
    """Token to twice its bucket, plus one for a negative sign; -1 for the empty token."""

    def __init__(self, dims: int):
        super().__init__({"": -1})
        self.dims = dims

    def __missing__(self, token: str) -> int:
        digest = hashlib.md5(token.encode()).hexdigest()
        slot = self[token] = int(digest[:8], 16) % self.dims * 2 + int(digest[8], 16) % 2
        return slot


class HashingProvider:
    """Feature hashing (Weinberger et al. 2009): a stand-in for a model.

    Every space-separated token adds +1 or -1 to one of ``dims`` numbers, both
    picked by its MD5; the sum is scaled to unit length. Deterministic and good
    for testing data flow; it carries no meaning.
    """

    _REMEMBER = 1_000_000

    def __init__(self, dims: int = 64):
        self.dims = dims
        self._slots = _Slots(dims)

    def embed(self, texts: list[str], endpoint: str | None = None) -> np.ndarray:
        if len(self._slots) > self._REMEMBER:
            self._slots = _Slots(self.dims)
        look_up, n = self._slots.__getitem__, len(texts)
        found = [list(map(look_up, text.split(" "))) for text in texts]
        slots = np.fromiter(chain.from_iterable(found), dtype=np.int64)
        rows = np.repeat(np.arange(n), [len(tokens) for tokens in found])
        full = slots >= 0
        slots, rows = slots[full], rows[full]
        sums = np.bincount(
            rows * self.dims + slots // 2, weights=1.0 - 2.0 * (slots % 2), minlength=n * self.dims
        ).reshape(n, self.dims)
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True)) + EPSILON
        return sums / norms


def inputs_payload(texts: Sequence[str]) -> dict:
    """Request body of services that take ``inputs`` and truncate long ones."""
    return {"inputs": list(texts), "truncate": True}


def text_payload(texts: Sequence[str]) -> dict:
    """Request body of services that take ``text``."""
    return {"text": list(texts)}


def parse_vectors(response: Any) -> list:
    """Vectors of one response: bare, each in a list of its own, or either under ``embeddings``.

    How deep the answer is nested is decided once, for all of its vectors; a mixed or
    deeper answer raises ``ValueError``.
    """
    answer = response.get("embeddings") if isinstance(response, dict) else response
    if not isinstance(answer, list):
        raise ValueError("no list of vectors")
    depths = {_depth(item) for item in answer}
    if depths <= {1}:
        return answer
    if depths != {2} or any(len(item) != 1 for item in answer):
        raise ValueError(f"vectors nested {sorted(depths)} deep")
    return [only for item in answer for only in item]


def _depth(item: Any) -> int:
    """Levels of lists around the first number."""
    levels = 0
    while isinstance(item, list):
        levels += 1
        item = item[0] if item else None
    return levels


class Connections(threading.local):
    """Open connections by host, one set per thread, kept from request to request."""

    def __init__(self):
        self.open: dict[tuple[str, str], http.client.HTTPConnection] = {}

    def post(self, url: str, body: dict, headers: dict[str, str], timeout: float) -> Any:
        parts = urlsplit(url)
        key = (parts.scheme, parts.netloc)
        if key not in self.open:
            kind = http.client.HTTPSConnection if parts.scheme == "https" else http.client.HTTPConnection
            self.open[key] = kind(parts.netloc, timeout=timeout)
        target = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
        try:
            self.open[key].request("POST", target, json.dumps(body), {"Content-Type": "application/json", **headers})
            answer = self.open[key].getresponse()
            content = answer.read()
        except Exception:
            # A connection in an unknown state is not used again; the caller's retry opens a new one.
            self.open.pop(key).close()
            raise
        if answer.status >= 300:
            raise OSError(f"{answer.status} {answer.reason}")
        return json.loads(content)


class HttpProvider:
    """A JSON-over-HTTP embedding service."""

    def __init__(
        self,
        payload: Callable[[Sequence[str]], dict] = inputs_payload,
        token: str | None = None,
        timeout: float = 120.0,
        post: Callable[[str, dict, dict[str, str], float], Any] | None = None,
    ):
        self.payload = payload
        self.headers = {"Authorization": f"Bearer {token}"} if token else {}
        self.timeout = timeout
        self.post = post or Connections().post

    def embed(self, texts: list[str], endpoint: str | None) -> list:
        return parse_vectors(self.post(endpoint, self.payload(texts), self.headers, self.timeout))
