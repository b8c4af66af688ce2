"""Embedding near-duplicates by product quantisation.

Vectors are scaled to length one. K-means on a bounded sample (``SAMPLE`` vectors, chosen by hash of the id)
gives coarse centroids, and a second k-means per subspace on the sample's residuals gives the codebooks. Every
vector enters the inverted list of its nearest centroid (within its label) with the codes of its residual and
the length of what they leave out.

Every vector is also a query. A vector within distance r of it (r belongs to the threshold) that lies nearer to
centroid c than to the query's own centroid o obeys ``|q-c|^2 - |q-o|^2 <= 2 r |c-o|``; the lists probed are those
that pass with ``MARGIN * r``. With MARGIN 1 no list can be missed, whatever directions the vectors vary in; a smaller
one loses links where they vary in few. In a list, table look-ups give the asymmetric distance to every
code; a vector stays while that distance is at most r plus its own code error, which loses none. The
rest is ranked by exact cosine in double precision.

Equal vectors of a label are one class with a count; links count all members. A list is cut into blocks of
rows on both the index and the query side, so that no list, however popular, is met in one task. A block sends
back per vector its number of links and one spanning edge, not the pairs.

Defined results: null, zero or non-finite vectors, null labels and null ids link with nothing (n_links 0; kept is
true and component the own id, both null-safe: a null id has component null and kept false); vectors of different
length never link; repeated rows are vectors of their own; ids that repeat with other vectors are one node;
empty tables give empty results. Columns besides vec_id, embedding and label are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverframe.llm.components import connected
from riverframe.llm.tables import hash_share
from riverframe.operators.settle import settle

THRESHOLD = 0.98
SAMPLE = 20_000
MARGIN = 1.0
PER_LIST = 500
MAX_LISTS = 4096
SUBSPACES = 8
CODES = 256
BLOCK = 2048
FEW_LISTS = 50_000
_SLACK = 1e-6


@dataclass
class Quantiser:
    centroids: np.ndarray  # lists x dims
    books: list[np.ndarray]  # codes x dims of each subspace
    cuts: list[int]

    def residual_codes(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rest = x - self.centroids[at]
        codes, error = np.zeros((len(x), len(self.books)), np.uint8), np.zeros(len(x))
        for m, book in enumerate(self.books):
            part = rest[:, self.cuts[m] : self.cuts[m + 1]]
            d = _distances(part, book)
            codes[:, m] = d.argmin(1)
            error += ((part - book[codes[:, m]]) ** 2).sum(1)
        return codes, np.sqrt(error)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ c.T + (c**2).sum(1), 0)


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    c = x[np.random.default_rng(11).choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = _distances(x, c).argmin(1)
        n = np.bincount(at, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c[n > 0] = total[n > 0] / n[n > 0][:, None]
    return c


def fit(x: np.ndarray, lists: int) -> Quantiser:
    """Quantiser of unit vectors ``x``."""
    c = _kmeans(x, lists)
    rest = x - c[_distances(x, c).argmin(1)]
    m = min(SUBSPACES, x.shape[1])
    cuts = [x.shape[1] * i // m for i in range(m + 1)]
    return Quantiser(c, [_kmeans(rest[:, a:b], CODES) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], cuts)


def _normal(x: np.ndarray) -> np.ndarray:
    """Rows of length one; by their largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _unit(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    return _normal(np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.float64).reshape(-1, dim))


def _radius(threshold: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * threshold)))


def _entries(batches, models: dict[int, Quantiser], threshold: float, margin: float, kind: str):
    """For every vector its own list with codes (kind 0), and the lists it probes (kind 1)."""
    r = _radius(threshold) * margin
    for batch in batches:
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        raw = batch.column("embedding")
        for dim in np.unique(dims):
            model, rows = models[int(dim)], np.flatnonzero(dims == dim)
            flat = raw.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = flat.reshape(-1, dim)
            unit = _normal(x)
            apart = np.sqrt(_distances(model.centroids, model.centroids))
            for a in range(0, len(rows), 4096):
                part, mine = unit[a : a + 4096], rows[a : a + 4096]
                d = _distances(part, model.centroids)
                own = d.argmin(1)
                codes, error = model.residual_codes(part, own)
                vector = [v.tobytes() for v in x[a : a + 4096].astype(kind)]
                q, probe = np.nonzero(d - d[np.arange(len(d)), own][:, None] <= 2 * r * apart[own] + _SLACK)
                at = np.concatenate([np.arange(len(mine)), q])
                index = np.arange(len(at)) < len(mine)
                who = batch.take(pa.array(mine[at]))
                yield pa.record_batch({
                    "kind": pa.array((~index).astype(np.int32)), "label": who.column("label"), "dim": who.column("dim"), "list": pa.array(np.concatenate([own, probe]).astype(np.int32)),
                    "node": who.column("node"), "n": who.column("n"), "vector": pa.array([vector[i] for i in at], pa.binary()),
                    "codes": pa.array([codes[i].tobytes() if e else None for i, e in zip(at, index, strict=True)], pa.binary()), "error": pa.array(error[at]),
                })


def _search(key, index: pa.Table, query: pa.Table, models: dict[int, Quantiser], threshold: float, kind: str) -> pa.Table:
    """Links between the queries and the index rows of one block of a list."""
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    if not index.num_rows or not query.num_rows:
        return schema.empty_table()
    dim, lst = key[1].as_py(), key[2].as_py()
    model, r = models[dim], _radius(threshold)
    own, times, error = (index.column(c).to_numpy() for c in ("node", "n", "error"))
    codes = np.frombuffer(b"".join(index.column("codes").to_pylist()), np.uint8).reshape(len(own), -1)
    target = _unit(index.column("vector"), dim, kind)
    asks, nodes, links, left, right = _unit(query.column("vector"), dim, kind), query.column("node").to_numpy(), [], [], []
    for a in range(0, len(nodes), 256):
        part = asks[a : a + 256]
        rest = part - model.centroids[lst]
        total = np.zeros((len(part), len(own)))
        for m, book in enumerate(model.books):
            total += _distances(rest[:, model.cuts[m] : model.cuts[m + 1]], book)[:, codes[:, m]]
        i, j = np.nonzero(np.sqrt(total) <= r + error + _SLACK)
        true = (nodes[a + i] != own[j]) & ((part[i] * target[j]).sum(1) >= threshold)
        i, j = i[true], j[true]
        links.append(np.bincount(i, times[j], len(part)).astype(np.int64))
        left.append(nodes[a + i]), right.append(own[j])
    a, b = np.concatenate(left), np.concatenate(right)
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root, x, y = np.arange(len(names)), at[: len(a)], at[len(a) :]
    while len(x):
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    count = np.concatenate(links)
    some = np.flatnonzero(count)
    return pa.table({"node": pa.array(np.concatenate([nodes[some], names])), "links": pa.array(np.concatenate([count[some], np.zeros(len(names), np.int64)])), "root": pa.array(np.concatenate([nodes[some], names[root]]))}, schema)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    spark = vectors.sparkSession
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"  # what a component travels as; the arithmetic is double
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    finite = "vec_id is not null and label is not null and embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(embedding, x -> x <> 0)"
    digest = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(7), "embedding").alias("h2"), F.size("embedding").alias("dim")]
    keys = ["label", "dim", "h1", "h2"]
    good = rows.where(F.expr(finite)).select("vec_id", "embedding", "label", *digest)
    classes = settle(good.groupBy(*keys).agg(F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("embedding").alias("embedding")), "vector-classes")
    sizes = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    models = {}
    for dim, n in sizes.items():
        sample = classes.where(F.col("dim") == dim).where(hash_share("h1") < min(1.0, SAMPLE / len(sizes) / n)).select("embedding").orderBy("embedding").limit(2 * SAMPLE).toArrow()
        x = np.array(sample.column("embedding").to_pylist() or [[1.0] * dim], np.float64)
        models[dim] = fit(_normal(x), int(min(MAX_LISTS, max(1, n // PER_LIST))))
    shared = spark.sparkContext.broadcast(models)
    entries = classes.select("label", "dim", "node", "n", "embedding").mapInArrow(
        lambda b: _entries(b, shared.value, threshold, margin, kind), "kind int, label string, dim int, list int, node long, n long, vector binary, codes binary, error double"
    )
    entries = settle(entries, "vector-entries")
    place = ["label", "dim", "list"]
    cuts = entries.groupBy(*place).agg(
        F.greatest(F.lit(1), F.ceil(F.sum(1 - F.col("kind")) / F.lit(BLOCK)).cast("int")).alias("index_blocks"), F.greatest(F.lit(1), F.ceil(F.sum("kind") / F.lit(BLOCK)).cast("int")).alias("query_blocks")
    )
    cuts = settle(cuts, "vector-cuts")
    # One small row per list: sent to the tasks where they are few, joined otherwise.
    spread = entries.join(F.broadcast(cuts) if cuts.count() <= FEW_LISTS else cuts, place)
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n).cast("long")).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    index = spread.where("kind = 0").select(*place, own("index_blocks").alias("i"), all_of("query_blocks").alias("q"), "node", "n", "vector", "codes", "error")
    # New names for the second reader of the same table.
    query = spread.where("kind = 1").select(*(F.col(c).alias(c) for c in (*place, "node", "vector")), all_of("index_blocks").alias("i"), own("query_blocks").alias("q"))
    cell = [*place, "i", "q"]
    found = settle(
        index.groupBy(*cell).cogroup(query.groupBy(*cell)).applyInArrow(lambda k, a, b: _search(k, a, b, shared.value, threshold, kind), "node long, links long, root long"), "vector-links"
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    part = connected(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    by_class = classes.select(*keys, "node", "n").join(links, "node", "left").join(part, "node", "left")
    named = good.select("vec_id", *keys).join(by_class, keys).select(
        F.col("vec_id").alias("id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.least(F.coalesce("component", "node"), "vec_id").alias("component")
    )
    per_id = named.groupBy("id").agg(F.max("links").alias("links"), F.min("component").alias("component"))
    return rows.select("vec_id").join(per_id, F.col("vec_id") == F.col("id"), "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"), F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept")
    )
