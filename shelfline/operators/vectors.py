"""Vector columns: batch embedding, width checks, exact and IVF cosine top-k.

Exact search never moves the corpus: the queries are dealt into blocks of at
most ``QUERY_BYTES``, each block travels to the corpus tasks, and a task keeps
the k best rows per query over all of its rows. An IVF index is a Parquet
table partitioned by cell beside a small table of the cells (centroid, number
of rows); a search joins the vectors with the probed cells on the partition
column, so Spark prunes the scan to them, and rows and queries meet by (cell,
salt) in bounded pieces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import constants as K
from shelfline.session import shared_dir

QUERY_BYTES = 32 << 20
PIECE_ROWS = 16_384
SIM_CELLS = 1 << 22  # rows x queries scored at once in a task (32 MB of doubles)
#: Bytes and rows that an encoder gets at once.
ENCODE_BYTES = 16 << 20
ENCODE_ROWS = 1024


# ------------------------------------------------------------- embedding

def embed_column(df: DataFrame, column: str, encoder_factory: Callable[[], Callable], out: str = "embedding", dim: int = K.EMBEDDING_DIM,
                 batch_bytes: int = ENCODE_BYTES, batch_rows: int = ENCODE_ROWS) -> DataFrame:
    """Encode ``column`` (text, or image bytes in a binary column) in Arrow batches; the encoder is built once per worker.

    ``encoder_factory()`` returns ``encode(list[str] | list[bytes]) -> array
    (n, dim)``; it gets at most ``batch_rows`` inputs of together about
    ``batch_bytes`` at once. Blank or null input, an encoder error, or a vector
    of the wrong width gives null; the row is always kept. A batch that fails
    is halved until it succeeds, so odd input costs only its own vector.
    """
    binary = isinstance(df.schema[column].dataType, T.BinaryType)

    def vectors(encode, inputs: list) -> list:
        try:
            vecs = np.asarray(encode(inputs), dtype=np.float32)
            if vecs.shape == (len(inputs), dim):
                return list(vecs)
        except Exception:  # noqa: BLE001 - whatever the encoder raises, the row stays
            pass
        half = len(inputs) // 2
        return vectors(encode, inputs[:half]) + vectors(encode, inputs[half:]) if half else [None]

    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder_factory()
        for batch in batches:
            found: list = [None] * len(batch)
            places: list[int] = []
            inputs: list = []
            held = 0

            def flush() -> None:
                for at, v in zip(places, vectors(encode, inputs) if inputs else []):
                    found[at] = v
                places.clear()
                inputs.clear()

            for at, x in enumerate(batch):
                x = x.as_py()
                if not (x if binary else (x or "").strip()):
                    continue
                if held + len(x) > batch_bytes or len(inputs) == batch_rows:
                    flush()
                    held = 0
                places.append(at)
                inputs.append(x)
                held += len(x)
            flush()
            yield pa.array(found, pa.list_(pa.float32()))

    return df.withColumn(out, F.arrow_udf(embed, T.ArrayType(T.FloatType()))(F.col(column) if binary else F.col(column).cast("string")))


def hashing_encoder_factory(dim: int = K.EMBEDDING_DIM, seed: int = 7):
    """A deterministic test encoder (token hashing + L2 norm). It makes no claim
    of matching any trained model; it exists so the pipeline runs end to end."""
    def factory():
        import xxhash

        def encode(texts):
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for i, t in enumerate(texts):
                toks = t.lower().split()
                if not toks:
                    continue
                h = np.fromiter((xxhash.xxh64_intdigest(x, seed=seed) for x in toks),
                                dtype=np.uint64, count=len(toks))
                sign = np.where((h >> np.uint64(63)) == 0, 1.0, -1.0)
                out[i] = np.bincount((h % np.uint64(dim)).astype(np.int64), weights=sign, minlength=dim)
            norms = np.linalg.norm(out, axis=1, keepdims=True)
            return out / np.where(norms == 0, 1.0, norms)
        return encode
    return factory


def valid_vectors(df: DataFrame, column: str, dim: int, drop: bool = False) -> DataFrame:
    """Null (or drop) vectors whose width is not ``dim``."""
    ok = F.coalesce(F.size(column) == dim, F.lit(False))
    if drop:
        return df.filter(ok)
    return df.withColumn(column, F.when(ok, F.col(column)))


# ------------------------------------------------------------ top-k core

def _normalise(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1.0, n)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Unit rows of vectors of one width."""
    return _normalise(pa.concat_arrays(c.flatten() for c in column.chunks).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1))


def _widths(column: pa.ChunkedArray) -> np.ndarray:
    return pc.list_value_length(column).to_numpy()


def _best(found: pa.Table, k: int, id_col: str) -> pa.Table:
    """The k best rows of every query (column ``query``), ties by the smaller id."""
    found = found.sort_by([("query", "ascending"), ("score", "descending"), (id_col, "ascending")])
    query = found["query"].to_numpy()
    place = np.arange(len(query))
    first = np.maximum.accumulate(np.where(np.diff(query, prepend=-1) != 0, place, 0))
    return found.filter(pa.array(place - first < k))


def _product(rows: pa.Table, asked: dict[int, tuple[np.ndarray, np.ndarray]], k: int, best: pa.Table, id_col: str, vec_col: str) -> pa.Table:
    """``best`` (query, id, score) after ``rows`` have been scored as well.

    ``asked``: by width, the numbers and unit vectors of the queries.
    """
    widths = _widths(rows[vec_col])
    for width, (numbers, vectors) in asked.items():
        mine = rows.filter(pa.array(widths == width))
        if not len(mine):
            continue
        m = _matrix(mine[vec_col])
        step = max(1, SIM_CELLS // len(m))
        for x in range(0, len(vectors), step):
            sims = m @ vectors[x:x + step].T
            kk = min(k, len(m))
            least = np.partition(sims, len(m) - kk, axis=0)[len(m) - kk]
            i, j = np.nonzero(sims >= least)
            found = pa.table({"query": numbers[x + j], id_col: mine[id_col].take(pa.array(i)), "score": sims[i, j]})
            best = _best(pa.concat_tables([best, found.cast(best.schema)]), k, id_col)
    return best


def _none(id_type: pa.DataType, id_col: str) -> pa.Table:
    return pa.table({"query": pa.array([], pa.int64()), id_col: pa.array([], id_type), "score": pa.array([], pa.float64())})


def _by_width(vectors: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    widths = _widths(vectors)
    return {int(w): (np.flatnonzero(widths == w), _matrix(vectors.filter(pa.array(widths == w)))) for w in np.unique(widths)}


def _topk_schema(queries: DataFrame, query_id: str, corpus: DataFrame, id_col: str) -> T.StructType:
    return T.StructType([T.StructField("query_id", queries.schema[query_id].dataType), T.StructField(id_col, corpus.schema[id_col].dataType),
                         T.StructField("score", T.DoubleType())])


def _partial_topk(corpus: DataFrame, queries: DataFrame, k: int, keys: list[str], id_col: str, vec_col: str,
                  query_id: str, query_vec: str) -> DataFrame:
    """Rows (query_id, id, score): the k best corpus rows per query and group of ``keys``."""
    def score(rows: pa.Table, asked: pa.Table) -> pa.Table:
        best = _none(rows.schema.field(id_col).type, id_col)
        if len(rows) and len(asked):
            best = _product(rows, _by_width(asked[query_vec]), k, best, id_col, vec_col)
        return pa.table({"query_id": asked[query_id].take(best["query"]), id_col: best[id_col], "score": best["score"]})

    return corpus.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(score, _topk_schema(queries, query_id, corpus, id_col))


def _final_topk(partial: DataFrame, k: int, id_col: str) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(id_col).asc())
    ranked = partial.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def _usable(v: str) -> Column:
    return F.coalesce(F.size(v) > 0, F.lit(False))


def _parts(n: int, size: int) -> int:
    return max(1, -(-n // size))


def cosine_topk(corpus: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "id",
                vec_col: str = "embedding", query_id: str = "query_id",
                query_vec: str = "query_vec", exclude_self: bool = False) -> DataFrame:
    """Exact cosine top-k of every query over the corpus, as (query_id, id, score, rank).

    Null and empty vectors are excluded, a query meets only vectors of its own
    width, and ties break on the smaller id. The queries' bytes are measured
    first; a block of them is at most ``QUERY_BYTES``, so what goes to the
    tasks is bounded. Each block is one scan of the corpus, whose vectors
    never pass an exchange; only k rows per query leave a task. Several blocks
    run one after the other, their results staged.
    """
    spark = corpus.sparkSession
    rows = corpus.select(id_col, vec_col).filter(_usable(vec_col))
    asked = queries.select(query_id, query_vec).filter(_usable(query_vec))
    most = k + 1 if exclude_self else k
    measured = asked.agg(F.sum(F.size(query_vec) * 8 + 32)).first()[0] or 0
    blocks = _parts(measured, QUERY_BYTES)
    schema = _topk_schema(queries, query_id, corpus, id_col)

    def searched(block: pa.Table) -> DataFrame:
        held = spark.sparkContext.broadcast((block[query_id], _by_width(block[query_vec])))

        def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, by_width = held.value
            best = None
            for batch in batches:
                table = pa.Table.from_batches([batch])
                best = _none(batch.schema.field(id_col).type, id_col) if best is None else best
                best = _product(table, by_width, most, best, id_col, vec_col)
            if best is not None and len(best):
                yield from pa.table({"query_id": names.take(best["query"]), id_col: best[id_col], "score": best["score"]}).to_batches()

        found = rows.mapInArrow(product, schema)
        if blocks == 1:
            return found
        path = shared_dir(spark, "topk")
        found.write.parquet(path)
        held.unpersist()
        return spark.read.schema(schema).parquet(path)

    out = None
    for b in range(blocks):
        mine = asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64(query_id, query_vec), F.lit(blocks)) == b)
        found = searched(mine.toArrow())
        out = found if out is None else out.unionByName(found)
    if exclude_self:
        out = out.filter(F.col("query_id") != F.col(id_col))
    return _final_topk(out, k, id_col)


# ------------------------------------------------------------------ IVF

class IvfIndex(NamedTuple):
    """vectors: the corpus with its ``cell``, partitioned by it; cells: (cell, centroid, rows), one row per cell."""

    vectors: DataFrame
    cells: DataFrame


def train_ivf(corpus: DataFrame, vec_col: str = "embedding", lists: int = K.IVF_LISTS, seed: int = 1, max_iter: int = 20, dim: int | None = None) -> np.ndarray:
    """K-means cells on L2-normalised vectors (cosine geometry) of ``dim`` values (else of the most frequent width).

    Returns the centroid matrix (``lists`` x dim, bounded by ``lists``).
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    if dim is None:
        widths = corpus.filter(_usable(vec_col)).groupBy(F.size(vec_col).alias("w")).count().orderBy(F.desc("count"), "w").first()
        dim = widths["w"] if widths else 0
    vecs = corpus.filter(F.size(vec_col) == dim).select(array_to_vector(_normalised_col(vec_col)).alias("features"))
    model = KMeans(k=lists, seed=seed, maxIter=max_iter, featuresCol="features").fit(vecs)
    return np.vstack([c for c in model.clusterCenters()])


def _normalised_col(vec_col: str):
    v = F.col(vec_col).cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.transform(v, lambda x: F.when(norm > 0, x / norm).otherwise(x))


def assign_cells(corpus: DataFrame, centroids: np.ndarray, vec_col: str = "embedding", cell_col: str = "cell") -> DataFrame:
    """Nearest centroid per vector (bounded centroids, Arrow batches); null for a vector of another width."""
    cents = _normalise(np.asarray(centroids, dtype=np.float64))

    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = np.full(len(batch), -1, np.int32)
            column = pa.chunked_array([batch])
            ok = pc.list_value_length(batch).fill_null(-1).to_numpy() == cents.shape[1]
            if ok.any():
                out[ok] = np.argmax(_matrix(column.filter(pa.array(ok))) @ cents.T, axis=1)
            yield pa.array(out, mask=~ok)

    return corpus.withColumn(cell_col, F.arrow_udf(nearest, T.IntegerType())(F.col(vec_col)))


def build_ivf_index(corpus: DataFrame, path: str, vec_col: str = "embedding", lists: int = K.IVF_LISTS, seed: int = 1, centroids: np.ndarray | None = None) -> IvfIndex:
    """Write the index to ``path`` and return it; centroids are trained unless given.

    Vectors of another width than the centroids' stay out. Rows are rebalanced
    by cell: a cell of any size is split into files of Spark's advisory size.
    """
    spark = corpus.sparkSession
    cents = train_ivf(corpus, vec_col, lists, seed) if centroids is None else np.asarray(centroids, dtype=np.float64)
    celled = assign_cells(corpus.filter(F.size(vec_col) == cents.shape[1]), cents, vec_col)
    celled.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
    vectors = spark.read.schema(T.StructType([*corpus.schema.fields, T.StructField("cell", T.IntegerType())])).parquet(f"{path}/vectors")
    known = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(cents)], "cell int, centroid array<double>")
    counts = vectors.groupBy("cell").agg(F.count("*").alias("rows"))
    known.join(counts, "cell", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("long"))).coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    return read_ivf_index(spark, path)


def read_ivf_index(spark: SparkSession, path: str) -> IvfIndex:
    return IvfIndex(spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/cells"))


def ivf_topk(index: IvfIndex, queries: DataFrame, k: int = 10, nprobe: int = 10, id_col: str = "id", vec_col: str = "embedding",
             query_id: str = "query_id", query_vec: str = "query_vec") -> DataFrame:
    """Approximate top-k: each query is compared only with the rows of its
    ``nprobe`` nearest cells (all of them: exact).

    The probed cells, one row each with their number of pieces, are joined to
    the vectors on the partition column: one scan, pruned at run time to the
    folders of those cells. Cells of more than ``PIECE_ROWS`` rows are split.
    """
    spark = queries.sparkSession
    cells = index.cells.orderBy("cell").collect()  # one row per cell
    cents = _normalise(np.array([c["centroid"] for c in cells], dtype=np.float64))
    probe = min(nprobe, len(cents))

    def probed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                near = np.argsort(-(_normalise(np.vstack(batch[query_vec].to_numpy()).astype(np.float64)) @ cents.T), axis=1, kind="stable")[:, :probe]
                yield batch.assign(_cells=[row.tolist() for row in near])

    asked = queries.select(query_id, query_vec).filter(F.size(query_vec) == cents.shape[1])
    asked = asked.mapInPandas(probed, T.StructType([*asked.schema.fields, T.StructField("_cells", T.ArrayType(T.IntegerType()))]))
    # Written once: the queries are needed twice, and a pruning filter must be plain to be shared with its join.
    path = shared_dir(spark, "ivf-asked")
    asked.select(query_id, query_vec, F.explode("_cells").alias("cell")).write.parquet(path)
    asked = spark.read.parquet(path)
    pieces = index.cells.filter("rows > 0").select("cell", F.ceil(F.col("rows") / PIECE_ROWS).alias("_pieces"))
    wanted = pieces.join(asked.select("cell").distinct(), "cell", "left_semi")
    # At most one row per cell of the index, which bounds the broadcast; the join on the partition column prunes the scan.
    rows = index.vectors.select(id_col, vec_col, "cell").join(F.broadcast(wanted), "cell")
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.col("_pieces"))).drop("_pieces")
    asked = asked.join(pieces, "cell").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pieces") - 1))).drop("_pieces")
    return _final_topk(_partial_topk(rows, asked, k, ["cell", "_salt"], id_col, vec_col, query_id, query_vec), k, id_col)
