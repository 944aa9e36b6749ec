"""Nearest neighbours by inner product over randomly rotated one-bit codes (operator 12).

A vector, less the centre of a sample, is scaled to length one and turned by
a seeded random rotation; the signs of its components are its code, one bit
each.  Two correction scalars go with it: its length before scaling, and the
inner product of the turned vector with its own code.  A query is turned
likewise and cut to four bits a component, so that bit counts of the code and
the query's four bit planes give an unbiased estimate of the inner product,
with an error that is bounded with high probability by ``epsilon`` deviations.

Queries meet all codes, block by slice.  In a block, the best estimates are
scored exactly; the k-th score found is the bar, and every vector whose
estimate plus its error bound reaches the bar is scored on the original
vectors.  Each block gives its k best per query, from which the k best of all
slices are chosen.  The sample sets nothing but the centre; every vector is
coded, and none is left out but by its bound.

Equal vectors are one class with their k + 1 smallest ids (no more can be
among a query's k nearest), so a very common vector is one code.

Cases: vectors that are null, empty, zero, or hold null or non-finite
components neither ask nor are found; vectors of different length never meet;
fewer candidates than k are all returned; equal scores go by id, null ids
last; rows that repeat an id stay rows of their own, and a query leaves out
its own row only; no query or an empty table gives an empty result; other
columns are never read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewflow.llm.common import stage

EPSILON = 1.9           # deviations of the estimate that the bound covers
SAMPLE_ROWS = 4000      # classes that set the centre
SLICE = 8192            # classes, and
BLOCK = 8192            # queries, that meet in one group
PLANES = 4              # bits of a query's component
CELLS = 1 << 21         # estimates held at a time
PAIRS = 4096            # pairs scored at a time
WIDER = 4               # times k: the estimates whose exact scores set the bar
SEED = 11
CODE = "struct<code:binary,length:double,fit:double>"
FOUND = "query_row long, query_id long, row_id long, vec_id long, score double"


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A seeded random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words, the last filled with zeros."""
    rows, dim = bits.shape
    full = np.zeros((rows, -(-dim // 64) * 64), np.uint8)
    full[:, :dim] = bits
    return np.packbits(full, axis=1, bitorder="little").view(np.uint64)


def encode(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code words, lengths, fits) of the vectors less the centre; the fit is the code's inner product with its vector."""
    rest = vectors - centre
    length = np.sqrt((rest * rest).sum(1))
    turned = rest / np.where(length > 0, length, 1)[:, None] @ rotation(vectors.shape[1])
    fit = np.abs(turned).sum(1) / np.sqrt(vectors.shape[1])
    return words(turned >= 0), length, np.where(length > 0, fit, 1)


def estimate(queries: np.ndarray, shift: np.ndarray, codes: np.ndarray, length: np.ndarray, fit: np.ndarray,
             epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of queries and coded vectors, and the bounds of their errors.

    ``shift``: the queries' inner products with the centre."""
    dim = queries.shape[1]
    turned = queries @ rotation(dim)
    low, high = turned.min(1), turned.max(1)
    step = np.where(high > low, (high - low) / (2 ** PLANES - 1), 1)
    cut = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    met = np.zeros((len(queries), len(codes)), np.uint32)
    for j in range(PLANES):
        plane = words(cut >> j & 1)
        for w in range(codes.shape[1]):
            met += np.bitwise_count(plane[:, w, None] & codes[None, :, w]).astype(np.uint32) << j
    ones = np.bitwise_count(codes).sum(1, dtype=np.int64)
    signed = 2 * (low[:, None] * ones + step[:, None] * met) - (low * dim + step * cut.sum(1, dtype=np.int64))[:, None]
    size = np.sqrt((queries * queries).sum(1))
    spread = size[:, None] ** 2 * ((1 - fit * fit).clip(0) / max(dim - 1, 1)) + (step * step / 12)[:, None]
    return shift[:, None] + signed * (length / fit / np.sqrt(dim)), epsilon * np.sqrt(spread) * (length / fit)


def exact(queries: np.ndarray, vectors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (i, j), each summed alike wherever it stands."""
    out = np.empty(len(i))
    for at in range(0, len(i), PAIRS):
        part = slice(at, at + PAIRS)
        out[part] = np.einsum("ij,ij->i", queries[i[part]], vectors[j[part]])
    return out


def best(queries, shift, vectors, codes, length, fit, order: np.ndarray, k: int, epsilon: float) -> tuple[np.ndarray, ...]:
    """(i, j, score): the k highest scores of every query, equal ones by ``order``."""
    n, kept = len(vectors), []
    for at in range(0, len(queries), max(1, CELLS // n)):
        q = queries[at:at + max(1, CELLS // n)]
        if n <= k:
            i, j = (x.ravel() for x in np.indices((len(q), n)))
            score = exact(q, vectors, i, j)
        else:
            guess, error = estimate(q, shift[at:at + len(q)], codes, length, fit, epsilon)
            wide = min(n, WIDER * k)
            first = np.argpartition(-guess, wide - 1, axis=1)[:, :wide]
            known = exact(q, vectors, np.repeat(np.arange(len(q)), wide), first.ravel()).reshape(-1, wide)
            bar = np.partition(known, wide - k, axis=1)[:, wide - k]
            chosen = guess + error >= bar[:, None]
            np.put_along_axis(chosen, first, False, axis=1)
            i, j = np.nonzero(chosen)
            score = exact(q, vectors, i, j)
            i, j = np.concatenate([np.repeat(np.arange(len(q)), wide), i]), np.concatenate([first.ravel(), j])
            score = np.concatenate([known.ravel(), score])
            above = score >= bar[i]
            i, j, score = i[above], j[above], score[above]
        by = np.lexsort((order[j], -score, i))
        i, j, score = i[by], j[by], score[by]
        top = np.arange(len(i)) - np.searchsorted(i, i) < k
        kept.append((i[top] + at, j[top], score[top]))
    return tuple(map(np.concatenate, zip(*kept)))


def unpacked(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def packed(vectors: pa.Array) -> pa.Array:
    """Components in double precision, as bytes."""
    return pa.array([None if v is None else np.array(v, np.float64).tobytes() for v in vectors.to_pylist()], pa.binary())


def scan(k: int, epsilon: float):
    def block(asked: pa.Table, held: pa.Table) -> pa.Table:
        empty = pa.table({c: pa.array([], pa.float64() if c == "score" else pa.int64()) for c in
                          ("query_row", "query_id", "row_id", "vec_id", "score")})
        if not len(asked) or not len(held):
            return empty
        queries, vectors = unpacked(asked["vector"]), unpacked(held["vector"])
        codes = np.frombuffer(b"".join(held["code"].to_pylist()), np.uint64).reshape(len(vectors), -1)
        ids, rows = held["ids"].to_pylist(), held["row_ids"].to_pylist()
        # one class more than k: the query's own may hold no other row
        order = np.array([np.iinfo(np.int64).max if x[0] is None else x[0] for x in ids])
        i, j, score = best(queries, asked["shift"].to_numpy(), vectors, codes, held["length"].to_numpy(), held["fit"].to_numpy(),
                           order, k + 1, epsilon)
        each = np.array([len(x) for x in rows])[j]
        found = pd.DataFrame({"i": np.repeat(i, each), "score": np.repeat(score, each),
                              "row_id": np.array([r for x in j for r in rows[x]], np.int64),
                              "vec_id": pd.array([v for x in j for v in ids[x]], dtype="Int64")})
        found["query_row"], found["query_id"] = asked["row_id"].to_numpy()[found["i"]], asked["vec_id"].to_numpy()[found["i"]]
        found = found[found["row_id"] != found["query_row"]].sort_values(["i", "score", "vec_id", "row_id"], ascending=[True, False, True, True])
        found = found[found.groupby("i").cumcount() < k]
        return pa.Table.from_pandas(found[empty.column_names], empty.schema, preserve_index=False)
    return block


def centres(classes: DataFrame, sample_rows: int) -> DataFrame:
    """(dim, centre): mean of the sample, the ``sample_rows`` classes with the smallest seeded hash."""
    def mean(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("class_id")
        return pd.DataFrame({"dim": rows["dim"][:1], "centre": [np.stack([np.frombuffer(v) for v in rows["vector"]]).mean(0).tobytes()]})
    sample = classes.orderBy(F.xxhash64(F.lit(SEED), "class_id"), "class_id").limit(sample_rows).select("dim", "class_id", "vector")
    return stage(sample.groupBy("dim").applyInPandas(mean, "dim int, centre binary"), "onebit-centres")


def coded(vectors: pa.Array, centre: pa.Array) -> pa.Array:
    out, by_size = [None] * len(vectors), {}
    rows, centre = vectors.to_pylist(), centre.to_pylist()
    for at, v in enumerate(rows):
        by_size.setdefault(len(v), []).append(at)
    for size, places in by_size.items():
        x = np.frombuffer(b"".join(rows[p] for p in places)).reshape(len(places), -1)
        mid = np.frombuffer(centre[places[0]]) if centre[places[0]] else np.zeros(size // 8)
        for p, code, length, fit in zip(places, *encode(x, mid)):
            out[p] = {"code": code.tobytes(), "length": float(length), "fit": float(fit)}
    return pa.array(out, pa.struct([("code", pa.binary()), ("length", pa.float64()), ("fit", pa.float64())]))


def along(vectors: pa.Array, centre: pa.Array) -> pa.Array:
    """Inner product with the centre."""
    return pa.array([float(np.frombuffer(v) @ np.frombuffer(c)) if c else 0.0 for v, c in zip(vectors.to_pylist(), centre.to_pylist())], pa.float64())


def search(vectors: DataFrame, asks: Column, k: int, epsilon: float = EPSILON, sample_rows: int = SAMPLE_ROWS,
           slice_rows: int = SLICE, block_rows: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows of highest inner product with every row for which ``asks`` holds: query_row, query_id, rank, vec_id,
    score; ``query_row`` tells rows with one id apart."""
    v = F.col(vector_col).cast("array<double>")
    sound = (F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("long").alias("vec_id"), F.size(v).alias("dim"),
                          F.coalesce(asks, F.lit(False)).alias("asks"), F.when(sound, v).alias("sound")).where("sound IS NOT NULL")
    rows = stage(rows.withColumn("vector", F.arrow_udf(packed, "binary")("sound")).drop("sound"), "onebit-rows")
    # equal vectors are one class; a class's ids beyond the first k + 1 can be nobody's neighbour before them
    equal = Window.partitionBy("dim", "digest").orderBy(F.col("vec_id").asc_nulls_last(), "row_id")
    firsts = (rows.select("row_id", "vec_id", "dim", "vector", F.sha2("vector", 256).alias("digest"))
              .withColumn("at", F.row_number().over(equal)).where(F.col("at") <= k + 1))
    members = F.array_sort(F.collect_list(F.struct("at", "vec_id", "row_id")))
    classes = stage(firsts.groupBy("dim", "digest").agg(members.alias("m"), F.first("vector").alias("vector"), F.min("row_id").alias("class_id"))
                    .select("dim", "class_id", "vector", F.col("m.vec_id").alias("ids"), F.col("m.row_id").alias("row_ids")), "onebit-classes")
    middle = centres(classes, sample_rows)
    index = stage(classes.join(middle, "dim", "left").withColumn("c", F.arrow_udf(coded, CODE)("vector", "centre"))
                  .select("dim", "class_id", "vector", "ids", "row_ids", "c.*"), "onebit-index")
    queries = stage(rows.where("asks").join(middle, "dim", "left")
                    .select("dim", "row_id", "vec_id", "vector", F.arrow_udf(along, "double")("vector", "centre").alias("shift")), "onebit-queries")

    def parts(table, n, into):
        return table.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / n).cast("int").alias(into))
    deal = stage(parts(index, slice_rows, "slices").join(parts(queries, block_rows, "blocks"), "dim"), "onebit-deal")

    def dealt(table, key, own, other):
        """A row of a table lies in one of its own parts, and goes to each of the other table's."""
        ways = {own: F.pmod(F.xxhash64(key), F.col(own + "s")).cast("int"), other: F.explode(F.sequence(F.lit(0), F.col(other + "s") - 1))}
        return table.join(deal, "dim").select(*table.columns, *[c.alias(n) for n, c in ways.items()]).groupBy("dim", "slice", "block")
    found = (dealt(queries, "row_id", "block", "slice").cogroup(dealt(index, "class_id", "slice", "block"))
             .applyInArrow(scan(k, epsilon), FOUND))
    nearest = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row_id")
    return (stage(found, "onebit-found").withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
            .select("query_row", "query_id", "rank", "vec_id", "score"))
