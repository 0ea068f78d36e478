"""Category segmentation: clean distinct names, embed, PCA keeping a share of the
variance, KMeans, and one name per group.

All fitting is Spark ML (distributed statistics; only model metadata such as
the explained-variance vector reaches the driver).  Names travel with their
vectors, so nothing is matched by position.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Non-null values of `col`, underscores turned into spaces, de-duplicated, with counts."""
    c = F.replace(F.col(col), F.lit("_"), F.lit(" "))
    return df.filter(F.col(col).isNotNull()).groupBy(c.alias("category")).agg(F.count(F.lit(1)).alias("n"))


def embed_text(df: DataFrame, text_col: str, num_features: int = 1 << 12) -> DataFrame:
    """TF-IDF embedding (tokenize -> hashed term frequencies -> IDF -> L2 normalise), column
    ``embedding`` (vector).  Words share `num_features` hash buckets: with many more distinct words
    than that, unlike texts come closer.  Any other embedding function can be supplied as a DataFrame
    transform instead."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer

    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern="\\W+", minTokenLength=2),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="embedding", p=2.0),
    ])
    src = df.filter(F.col(text_col).isNotNull())
    return pipe.fit(src).transform(src).drop("_tok", "_tf", "_idf")


def pca_by_variance(df: DataFrame, vec_col: str, share: float = 0.95, out_col: str = "pca"):
    """Centre the vectors, fit a full PCA, keep the first k components whose cumulative
    explained variance reaches `share`.  Returns (frame with `out_col`, k).  Vectors (arrays) of more than
    FULL_FIT entries go by ``pca_subspace``, which needs no square matrix."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    d = df.withColumn("_v", array_to_vector(F.col(vec_col)) if dict(df.dtypes)[vec_col].startswith("array")
                      else F.col(vec_col))
    dim = len(d.select("_v").first()[0])
    if dim > FULL_FIT:
        out, k = pca_subspace(d.withColumn("_v", vector_to_array("_v")), "_v", share, out_col)
        return out.withColumn(out_col, array_to_vector(F.col(out_col))).drop("_v"), k
    scaler = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(d)
    c = scaler.transform(d)
    pca = PCA(k=dim, inputCol="_c", outputCol="_p").fit(c)
    ev = pca.explainedVariance.toArray()
    k, acc = 0, 0.0
    for v in ev:
        k += 1
        acc += float(v)
        if acc >= share - 1e-12:
            break
    out = pca.transform(c).withColumn(out_col, array_to_vector(F.slice(vector_to_array(F.col("_p")), 1, k)))
    return out.drop("_v", "_c", "_p"), k


FULL_FIT = 1024  # entries of a vector up to which a square matrix is fitted on the driver
START_RANK, PASSES, SETTLED = 16, 40, 1e-9  # of the subspace iteration


def pca_subspace(df: DataFrame, vec_col: str, share: float = 0.95, out_col: str = "pca", start: int = START_RANK,
                 passes: int = PASSES, settled: float = SETTLED):
    """The same as ``pca_by_variance`` for vectors (arrays) of any length, without a square matrix: returns (frame with
    `out_col` as an array, k).

    A block of `start` directions is multiplied by the covariance again and again (each pass streams the
    vectors once through the executors and sums one short row a dimension) until its share of the
    variance settles; while that share is too small, the block is doubled.  The driver holds
    dimensions x directions numbers."""
    spark = df.sparkSession
    about = df.select(F.posexplode(vec_col).alias("i", "v")).groupBy("i").agg(
        F.avg("v").alias("m"), F.var_pop("v").alias("s"), F.count(F.lit(1)).alias("n")).orderBy("i").collect()
    mean, total, n, dim = np.array([r["m"] for r in about]), sum(r["s"] for r in about), about[0]["n"], len(about)
    rng = np.random.default_rng(42)

    def times_covariance(block: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast((mean, block))

        def product(parts):
            m, q = sent.value
            out = np.zeros(q.shape)
            for p in parts:
                x = p.column(0).flatten().to_numpy(zero_copy_only=False).reshape(p.num_rows, len(m)) - m
                out += x.T @ (x @ q)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(m))), pa.array(list(out), pa.list_(pa.float64()))], names=["i", "row"])

        parts = df.select(F.col(vec_col).cast("array<double>").alias("v")).mapInArrow(product, "i long, row array<double>")
        cells = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
        out = np.zeros(block.shape)
        for r in cells:
            out[r["i"], r["j"]] = r["x"]
        sent.unpersist()
        return out / n

    rank = min(start, dim)
    block = np.linalg.qr(rng.normal(size=(dim, rank)))[0]
    while True:
        before = -1.0
        for _ in range(1 if rank == dim else passes):
            image = times_covariance(block)
            values, turn = np.linalg.eigh(block.T @ image)
            values, turn = values[::-1], turn[:, ::-1]
            found = values.sum() / total if total > 0 else 1.0
            directions = block @ turn
            if abs(found - before) < settled:
                break
            before = found
            block = np.linalg.qr(image @ turn)[0]
        if found >= share - 1e-12 or rank == dim:
            break
        rank = min(2 * rank, dim)
        more = rng.normal(size=(dim, rank - block.shape[1]))
        block = np.linalg.qr(np.column_stack([block, more]))[0]
    explained = np.cumsum(values) / total if total > 0 else np.ones(rank)
    k = int(min(rank, np.searchsorted(explained, share - 1e-12) + 1))
    turn = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(directions.shape[1])])
    sent = spark.sparkContext.broadcast((mean, (directions * np.where(turn == 0, 1, turn))[:, :k]))

    @F.arrow_udf("array<double>")
    def project(v: pa.Array) -> pa.Array:
        m, q = sent.value
        x = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), len(m)) - m
        return pa.array(list(x @ q), pa.list_(pa.float64()))

    return df.withColumn(out_col, project(F.col(vec_col).cast("array<double>"))), k


def kmeans(df: DataFrame, vec_col: str, k: int = 18, seed: int = 42, out_col: str = "cluster") -> DataFrame:
    from pyspark.ml.clustering import KMeans
    model = KMeans(k=k, seed=seed, featuresCol=vec_col, predictionCol=out_col).fit(df)
    return model.transform(df)


def _centroid_distance(df: DataFrame, key: str, vec_col: str) -> DataFrame:
    """Squared distance of each member to its group's centroid.  Centroids are a grouped
    ``Summarizer.mean`` (partial aggregation of whole vectors, one small row per group);
    distances are computed in-row with ``zip_with`` — vectors are never exploded."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    v = df.withColumn("_vec", array_to_vector(F.col(vec_col)))
    cen = v.groupBy(key).agg(Summarizer.mean(F.col("_vec")).alias("_c")) \
        .select(key, vector_to_array(F.col("_c")).alias("_c"))
    cen = cen.withColumnRenamed(key, "_ck")
    j = v.join(cen, v[key].eqNullSafe(cen["_ck"])).drop("_ck")  # a null group is a group
    sq = F.zip_with(F.col(vec_col), F.col("_c"), lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
    return j.select(key, "_name", F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x).alias("_d"))


def name_groups(df: DataFrame, key: str, name_col: str, vec_col: str) -> DataFrame:
    """One name per group: a single-member group keeps its member's name; a larger group is
    named after the member nearest its centroid (ties by name).  Output: key, n_members,
    group_name.  Members are never gathered into one row."""
    d = df.select(key, F.col(name_col).alias("_name"), vec_col)
    dist = _centroid_distance(d, key, vec_col)
    # nearest member and size in one partial aggregation (a hot group is reduced map-side)
    g = dist.groupBy(key).agg(F.count(F.lit(1)).alias("n_members"), F.min(F.struct("_d", "_name")).alias("_near"),
                              F.min("_name").alias("_only"))
    return g.select(key, "n_members", F.when(F.col("n_members") == 1, F.col("_only"))
                    .otherwise(F.col("_near._name")).alias("group_name"))


def category_mapping(df: DataFrame, key: str, name_col: str, names: DataFrame) -> DataFrame:
    """original name -> higher-order (group) name, one row per member."""
    d, n = df.select(key, F.col(name_col).alias("original_category")), names.select(F.col(key).alias("_nk"), "group_name")
    return d.join(n, d[key].eqNullSafe(n["_nk"])).select("original_category", F.col("group_name").alias("higher_order_category"))
