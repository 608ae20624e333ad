"""Vector expressions over ``array<float>`` columns; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: added to every norm so that a zero vector stays zero.
EPSILON = 1e-12


def unwrap_nested(vectors: Column) -> Column:
    """``[[v]]`` to ``v``: the single inner vector of a nested response.

    Null where there is not exactly one; :func:`is_bad_nesting` tells such rows from null input.
    """
    return F.when(~is_bad_nesting(vectors), F.get(vectors, F.lit(0)))


def is_bad_nesting(vectors: Column) -> Column:
    """Whether a nested response holds other than one vector, so that none can be taken from it."""
    return F.coalesce(F.size(vectors) != 1, F.lit(True))


def as_float32(vector: Column) -> Column:
    return vector.cast("array<float>")


def l2_norm(vector: Column) -> Column:
    return F.sqrt(
        F.aggregate(
            vector,
            F.lit(0.0),
            lambda total, x: total + x.cast("double") * x.cast("double"),
        )
    )


def l2_normalize(vector: Column) -> Column:
    # The one-element array binds the norm to a lambda variable, so that it is
    # computed once per vector and not once per element.
    bound = F.array(F.struct(vector.alias("v"), (l2_norm(vector) + EPSILON).alias("n")))
    scaled = F.transform(bound, lambda b: F.transform(b["v"], lambda x: x.cast("double") / b["n"]))
    return as_float32(F.get(scaled, F.lit(0)))


def truncate_embedding(vector: Column, dims: int) -> Column:
    """Keep the first ``dims`` numbers and bring the rest back to unit length."""
    return l2_normalize(F.slice(vector, 1, dims))


def vector_json(vector: Column) -> Column:
    return F.to_json(vector)


def point_json(id_: Column, vector: Column) -> Column:
    """One upload payload for a vector store: ``{"id": …, "embedding": […]}``."""
    return F.to_json(F.struct(id_.alias("id"), vector.alias("embedding")))
