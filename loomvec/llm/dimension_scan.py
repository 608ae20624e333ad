"""Nearest neighbours by inverted lists and an adaptive scan of rotated dimensions.

Vectors get one more component that gives all the same length, which turns the largest inner
product into the smallest distance; then all are turned by one random rotation. A k-means model
of a bounded sample deals every vector to a list; a query probes the lists whose centres are
nearest, and more of them until they hold enough candidates for its rows. Within a list, column blocks of the rotated vectors are added to partial
distances; after each block a hypothesis test drops candidates whose distance is, by what
is seen so far, too large for the query's best ``k``. The nearest list is scanned first, and the ``k``-th distance found
there goes along to the query's other lists. Survivors are scored on the original vectors in double precision, component by
component in order, so that a score depends on the two vectors alone and equal vectors tie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomvec.llm.vectors import is_whole
from loomvec.session import materialise


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the vectors the model is fitted on; ``block`` and ``chunk`` the rows of one task's group."""

    k: int = 20
    every: int = 20
    sample: int = 16_000
    most_lists: int = 2048
    rounds: int = 8
    reach: float = 0.985
    block: int = 4096
    chunk: int = 512
    columns: int = 16
    caution: float = 2.5
    seed: int = 3


@dataclass(frozen=True)
class Model:
    centres: np.ndarray
    rotation: np.ndarray
    length: float
    probes: int

    def turn(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Rotated vectors with the added component: rows by their share of the largest length, queries at length 1."""
        if query:
            vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
            vectors = vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))
            left = np.zeros(len(vectors))
        else:
            vectors = vectors / self.length
            left = np.sqrt(np.maximum(1 - (vectors**2).sum(axis=1), 0))
        return (np.column_stack((vectors, left)) @ self.rotation).astype(np.float32)

    def nearest(self, turned: np.ndarray, n: int) -> np.ndarray:
        far = (self.centres**2).sum(axis=1) - 2 * turned @ self.centres.T
        n = min(n, far.shape[1])
        return np.argpartition(far, n - 1, axis=1)[:, :n] if n < far.shape[1] else np.tile(np.arange(n), (len(turned), 1))

    def probed(self, turned: np.ndarray, sizes: np.ndarray, least: int) -> list[np.ndarray]:
        """Per query its nearest lists: ``probes`` of them, and on until they hold ``least`` rows by ``sizes``."""
        order = ((self.centres**2).sum(axis=1) - 2 * turned @ self.centres.T).argsort(axis=1, kind="stable")
        filled = (np.cumsum(sizes[order], axis=1) < least).sum(axis=1) + 1
        return [lists[: max(self.probes, n)] for lists, n in zip(order, filled.tolist())]


def fit(vectors: np.ndarray, total: int, length: float, settings: Settings) -> Model:
    """Rotation, centres and number of probes from a sample of ``vectors`` standing for ``total`` rows."""
    rng = np.random.default_rng(settings.seed)
    d = vectors.shape[1] + 1
    rotation = np.linalg.qr(rng.normal(size=(d, d)))[0]
    bare = Model(np.zeros((1, d), np.float32), rotation, length, 1)
    turned = bare.turn(vectors, query=False)
    lists = int(min(settings.most_lists, max(1, round(total**0.5 / 2)), max(1, len(turned) // 8)))
    centres = turned[rng.permutation(len(turned))[:lists]].copy()
    for _ in range(settings.rounds if lists > 1 else 0):
        far = (centres**2).sum(axis=1) - 2 * turned @ centres.T
        own = far.argmin(axis=1)
        count = np.bincount(own, minlength=lists)
        sums = np.zeros((lists, d))
        np.add.at(sums, own, turned)
        some = count > 0
        centres[some] = (sums[some] / count[some, None]).astype(np.float32)
        centres[~some] = turned[rng.integers(0, len(turned), int((~some).sum()))]
    model = Model(centres, rotation, length, 1)
    # The number of probes that reaches nearly all true neighbours of sampled queries.
    ask = rng.permutation(len(turned))[:300]
    inner = vectors[ask] @ vectors.T
    inner[np.arange(len(ask)), ask] = -np.inf
    k = min(settings.k, len(turned) - 1)
    if k < 1 or lists == 1:
        return Model(centres, rotation, length, lists)
    best = np.argpartition(-inner, k - 1, axis=1)[:, :k]
    turned_ask = model.turn(vectors[ask], query=True)
    far = (centres**2).sum(axis=1) - 2 * turned_ask @ centres.T
    place = np.empty_like(far, dtype=np.int64)
    np.put_along_axis(place, far.argsort(axis=1), np.arange(lists)[None, :], axis=1)
    own = ((centres**2).sum(axis=1) - 2 * turned @ centres.T).argmin(axis=1)
    needed = np.sort(np.take_along_axis(place, own[best], axis=1).ravel())
    probes = int(needed[min(len(needed) - 1, int(settings.reach * len(needed)))]) + 1
    return Model(centres, rotation, length, min(lists, probes))


def _clean(vectors: DataFrame) -> DataFrame:
    """Vectors that take part: not null, no null or non-finite component, not zero."""
    kind = vectors.schema["embedding"].dataType.elementType
    value = F.col("embedding") if isinstance(kind, T.FloatType) else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("v"))
    rows = rows.where("vec_id is not null").where(is_whole(F.col("v"))).where(F.exists("v", lambda x: x != 0))
    # Shares of the largest component, whose squares neither overflow nor vanish.
    most = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    shares = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x.cast("double") / F.col("most")) * (x.cast("double") / F.col("most")))
    return rows.withColumn("size", F.size("v")).withColumn("most", most).withColumn("length", F.least(F.sqrt(shares) * F.col("most"), F.lit(1.7e308))).drop("most")


def _assign(parts: Iterator[pd.DataFrame], model: Model) -> Iterator[pd.DataFrame]:
    for rows in parts:
        for at in range(0, len(rows), 8192):
            part = rows.iloc[at : at + 8192]
            v = np.stack(part["v"].to_numpy()).astype(np.float64)
            own = model.nearest(model.turn(v, query=False), 1)[:, 0]
            yield pd.DataFrame({"vec_id": part["vec_id"], "v": part["v"], "list": own.astype(np.int32)})


def _probe(parts: Iterator[pd.DataFrame], model: Model, sizes: np.ndarray, least: int) -> Iterator[pd.DataFrame]:
    for rows in parts:
        for at in range(0, len(rows), 2048):
            part = rows.iloc[at : at + 2048]
            v = np.stack(part["v"].to_numpy()).astype(np.float64)
            found = model.probed(model.turn(v, query=True), sizes, least)
            lists = [x.astype(np.int32) for x in found]
            yield pd.DataFrame({"vec_id": part["vec_id"], "v": part["v"], "first": [x[0] for x in lists], "probed": [x[1:] for x in lists]})


def exact_scores(rows: np.ndarray, asks: np.ndarray) -> np.ndarray:
    """Inner products of each row with its ask, summed from the first component to the last."""
    score = np.zeros(len(rows))
    for at in range(rows.shape[1]):
        score += rows[:, at] * asks[:, at]
    return score


def _survivors(turned: np.ndarray, asks: np.ndarray, limit: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ask, row, distance)`` of the pairs whose partial distances pass the test after every column block."""
    d = turned.shape[1]
    # A first column block for all pairs at once, then the pairs that are left.
    end = min(d, settings.columns)
    part = (turned[:, :end] ** 2).sum(axis=1) - 2 * asks[:, :end] @ turned[:, :end].T + (asks[:, :end] ** 2).sum(axis=1)[:, None]
    ask, row = np.nonzero(part <= _bar(limit, end, d, settings)[:, None])
    far = part[ask, row]
    for begin in range(end, d, settings.columns):
        end = min(d, begin + settings.columns)
        far = far + ((turned[row, begin:end] - asks[ask, begin:end]) ** 2).sum(axis=1)
        stay = far <= _bar(limit, end, d, settings)[ask]
        ask, row, far = ask[stay], row[stay], far[stay]
    return ask, row, far


def _bar(limit: np.ndarray, seen: int, d: int, settings: Settings) -> np.ndarray:
    """The largest partial distance over ``seen`` of ``d`` columns that a pair within ``limit`` is likely to have."""
    # Rotation makes the seen share of a distance concentrate around seen / d of the whole.
    share = (seen / d) * (1 + settings.caution / np.sqrt(seen)) ** 2 if seen < d else 1 + 1e-4
    # Rounding of 32-bit distances between vectors of length 1.
    return limit * share + 1e-5


def _scan(rows: pd.DataFrame, model: Model, settings: Settings) -> pd.DataFrame:
    """Best candidates of one list block for one chunk of queries."""
    empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0), "far": np.zeros(0)})
    side = rows["side"].to_numpy()
    asks, held = rows[side == 1], rows[side == 0].sort_values("vec_id", kind="stable")
    if not len(asks) or not len(held):
        return empty
    ids, query_ids = held["vec_id"].to_numpy(), asks["vec_id"].to_numpy()
    plain, asked = (np.stack(part["v"].to_numpy()).astype(np.float64) for part in (held, asks))
    turned, turned_asks = model.turn(plain, query=False), model.turn(asked, query=True)
    limits = asks["far"].to_numpy().astype(np.float64)
    out = []
    step = max(1, (1 << 21) // len(held))
    for at in range(0, len(asks), step):
        some, limit = turned_asks[at : at + step], limits[at : at + step].copy()
        if len(held) > settings.k:
            # The first rows give a limit, too: the (k + 1)-th smallest distance, as a query may be in its own list.
            first = turned[: 4 * settings.k + 1]
            far = (first**2).sum(axis=1) - 2 * some @ first.T + (some**2).sum(axis=1)[:, None]
            limit = np.minimum(limit, np.partition(far, settings.k, axis=1)[:, settings.k])
        ask, row, far = _survivors(turned, some, limit, settings)
        other = ids[row] != query_ids[at + ask]
        ask, row, far = ask[other] + at, row[other], far[other]
        score = np.concatenate([exact_scores(plain[row[i : i + 65536]], asked[ask[i : i + 65536]]) for i in range(0, len(row), 65536)] or [np.zeros(0)])
        order = np.lexsort((ids[row], -score, ask))
        ask, row, far, score = ask[order], row[order], far[order], score[order]
        place = np.arange(len(ask)) - np.searchsorted(ask, ask, "left")
        best = place < settings.k
        out.append(pd.DataFrame({"query_id": query_ids[ask[best]], "vec_id": ids[row[best]], "score": score[best], "far": far[best].astype(np.float64)}))
    return pd.concat(out) if out else empty


def search(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the best ``k`` of every row whose vec_id ``every`` divides.

    Candidates are all rows with another vec_id and a vector of the same length; the order is by inner product, largest first,
    ties to the smaller vec_id. Vectors that are null, zero, or hold null or non-finite components take no part, nor do null
    vec_ids. Each length of vector is searched by itself. A repeated vec_id with several vectors of a length counts once, with
    the smallest. Fewer than ``k`` candidates give fewer rows, an empty table none; other columns are ignored.
    """
    clean = _clean(vectors)
    sizes = clean.groupBy("size").agg(F.max("length").alias("length")).orderBy("size").collect()
    parts = [_search(clean, row["size"], row["length"], settings) for row in sizes]
    if not parts:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, parts)


def _search(clean: DataFrame, size: int, length: float, settings: Settings) -> DataFrame:
    """The search among the vectors of one length; ``length`` is the largest norm there."""
    clean = clean.where(F.col("size") == size).groupBy("vec_id").agg(F.min("v").alias("v"))
    clean = materialise(clean, "vectors")
    total = clean.count()
    kind = clean.schema["v"].dataType.elementType.simpleString()
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))
    sample = clean.where(draw < min(1 << 30, (settings.sample << 30) // total)).orderBy("vec_id").toPandas()
    if not len(sample):
        sample = clean.limit(settings.sample).toPandas()
    model = fit(np.stack(sample["v"].to_numpy()).astype(np.float64), total, length, settings)
    placed = materialise(
        clean.mapInPandas(lambda parts: _assign(parts, model), f"vec_id long, v array<{kind}>, list int"), "lists"
    )
    held = np.zeros(len(model.centres), dtype=np.int64)
    for row in placed.groupBy("list").count().collect():
        held[row["list"]] = row["count"]
    # One row more than asked for, since a query is in a list itself.
    asks = placed.where(F.col("vec_id") % settings.every == 0).select("vec_id", "v").mapInPandas(
        lambda parts: _probe(parts, model, held, settings.k + 1), f"vec_id long, v array<{kind}>, first int, probed array<int>"
    )
    asks = materialise(asks, "asks")
    near = asks.select("vec_id", "v", F.col("first").alias("list"), F.lit(float("inf")).alias("far"))
    near = materialise(_scanned(placed, near, model, settings), "nearest-lists")
    # The k-th best of the nearest list is a limit for the others.
    limits = near.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n"), F.max("far").alias("_far"))
    limits = limits.where(F.col("n") >= settings.k).select("vec_id", "_far")
    rest = asks.join(limits, "vec_id", "left").select("vec_id", "v", F.explode("probed").alias("list"), F.coalesce("_far", F.lit(float("inf"))).alias("far"))
    found = near.unionByName(_scanned(placed, rest, model, settings))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _scanned(placed: DataFrame, asks: DataFrame, model: Model, settings: Settings) -> DataFrame:
    """Best candidates of each asked list; up to ``k`` rows for each query and block of a list."""
    asks = materialise(asks, "asked-lists")
    # Long lists are cut into blocks and their queries into chunks, so that a group is bounded.
    blocks = placed.groupBy("list").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("blocks"))
    chunks = asks.groupBy("list").agg(F.ceil(F.count("*") / settings.chunk).cast("int").alias("chunks"))
    shape = materialise(blocks.join(chunks, "list"), "shape")
    dealt = lambda n: F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    fields = ["side", "list", "block", "chunk", "vec_id", "v", "far"]
    left = placed.select("list", "vec_id", "v", F.lit(0.0).alias("far")).join(shape, "list")
    left = left.withColumn("side", F.lit(0)).withColumn("block", dealt("blocks")).withColumn("chunk", every("chunks"))
    right = asks.join(shape, "list").withColumn("side", F.lit(1)).withColumn("chunk", dealt("chunks")).withColumn("block", every("blocks"))
    return left.select(fields).union(right.select(fields)).groupBy("list", "block", "chunk").applyInPandas(
        lambda rows: _scan(rows, model, settings), "query_id long, vec_id long, score double, far double"
    )
