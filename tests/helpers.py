"""Small fixtures and their brute-force answers."""

import numpy as np

from eigenpool.functions.vectors import feature_array


def frame(spark, x, owners=None, ids=None):
    """points(id, owner, f) from a matrix."""
    x = np.asarray(x, dtype=float)
    ids = range(len(x)) if ids is None else ids
    owners = ["all"] * len(x) if owners is None else owners
    names = [f"c{j}" for j in range(x.shape[1])]
    rows = [(int(i), str(o), *map(float, r)) for i, o, r in zip(ids, owners, x)]
    df = spark.createDataFrame(rows, "id bigint, owner string, " + ", ".join(f"{c} double" for c in names))
    return df.select("id", "owner", feature_array(names))


def distances(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))


def with_copies(seed=0, n=160, d=2, hot=60):
    """Random rows of which a third are copies of one row, in shuffled order.

    Other distances do not tie, so neighbour lists are unique once copies go by id.
    """
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[rng.permutation(n)[:hot]] = x[0]
    return x
