"""Forests trained on cells: rows that no split can tell apart are one row with their number.

Features are cut into MLlib's 32 bins at most before the training, so a forest sees no more of a row than its bins and
its label. A tree's bootstrap draws each row a Poisson(1) number of times: n like rows together Poisson(n) times.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.session import settle

#: Bins of a feature, quantiles that its cuts are chosen from, and trees that are trained at a time.
BINS, QUANTILES, AT_ONCE = 32, 1024, 6


def cuts_of(values: Sequence[float], bins: int = BINS) -> list[float]:
    """Cuts between the values, at most one less than ``bins``: between all different ones, or at even steps of their number."""
    found, counts = np.unique(np.asarray(values, float), return_counts=True)
    middle = ((found[:-1] + found[1:]) / 2).tolist()
    if len(middle) >= bins:
        upto = np.cumsum(counts)[:-1]
        steps = np.searchsorted(upto, np.arange(1, bins) * counts.sum() / bins)
        middle = [middle[i] for i in np.unique(np.minimum(steps, len(middle) - 1))]
    return sorted(set(middle))


def binned(rows: DataFrame, columns: Sequence[str]) -> Bucketizer:
    """Stage that gives ``<column>_bin`` by cuts between the quantiles of the rows."""
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    found = rows.agg(*[F.percentile_approx(c, shares, 10 * QUANTILES).alias(c) for c in columns]).first()
    bounds = [cuts_of(found[c] or []) for c in columns]
    whole = [[-float("inf"), *cuts, float("inf")] if cuts else [-float("inf"), 0.0, float("inf")] for cuts in bounds]
    return Bucketizer(splitsArray=whole, inputCols=list(columns), outputCols=[f"{c}_bin" for c in columns], handleInvalid="keep")


def poisson(means: np.ndarray, uniforms: np.ndarray) -> np.ndarray:
    """The number of each mean's Poisson distribution at each of its row of uniforms."""
    out = np.empty(uniforms.shape, np.int64)
    for mean in np.unique(means):
        mine = np.flatnonzero(means == mean)
        reach = 12 * np.sqrt(mean) + 24
        low = max(0, int(mean - reach))
        k = np.arange(low + 1, int(mean + reach) + 1)
        logs = np.concatenate([[0.0], np.cumsum(np.log(mean / k))])
        upto = np.cumsum(np.exp(logs - logs.max()))
        out[mine] = low + np.minimum(np.searchsorted(upto / upto[-1], uniforms[mine], "right"), len(k))
    return out


def _uniforms(keys: np.ndarray, n: int) -> np.ndarray:
    """``n`` numbers in [0, 1) of each 64-bit key (splitmix64)."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64)[:, None] + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)) / float(1 << 53)


def _drawn(trees: int):
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A draw for every tree is wide, so cells go by in small steps.
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                counts = poisson(part.column("n").to_numpy(), _uniforms(part.column("key").to_numpy(), trees))
                offsets = pa.array(np.arange(part.num_rows + 1) * trees, pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(counts.ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("label"), part.column("bins"), lists], names=["label", "bins", "draws"])

    return draw


def train_forest(rows: DataFrame, prepared: Sequence, columns: Sequence[str], label: str, trees: int, seed: int) -> PipelineModel:
    """Pipeline of the prepared stages, bins and a forest of ``trees`` over the numeric columns of the rows.

    The work of a tree grows with the cells, of which there are as many as combinations of bins that occur.
    """
    bins = binned(rows, columns)
    names = bins.getOutputCols()
    values = F.array(*[F.col(c) for c in names])
    cells = bins.transform(rows).groupBy(F.col(label).cast("double").alias("label"), values.alias("bins")).agg(F.count(F.lit(1)).alias("n"))
    keyed = cells.withColumn("key", F.xxhash64(F.lit(seed), "label", "bins"))
    drawn = settle(keyed.mapInArrow(_drawn(trees), "label double, bins array<double>, draws array<bigint>"))
    top = drawn.agg(F.max("label")).first()[0]
    # Trees whose bootstrap misses a class know of it all the same.
    classes = {"ml_attr": {"type": "nominal", "vals": [str(i) for i in range(max(int(top or 0), 1) + 1)]}}
    ready = drawn.select(F.col("label").alias(label, metadata=classes), array_to_vector("bins").alias("features"), "draws")

    def tree(i: int):
        own = ready.withColumn("drawn", F.get("draws", F.lit(i)).cast("double")).where("drawn > 0").drop("draws")
        one = RandomForestClassifier(
            labelCol=label, weightCol="drawn", numTrees=1, bootstrap=False, featureSubsetStrategy="sqrt", seed=seed + i, maxBins=BINS + 1
        )
        return one.fit(own)._java_obj.trees()[0]

    with ThreadPool(min(AT_ONCE, trees)) as pool:
        fitted = pool.map(inheritable_thread_target(rows.sparkSession)(tree), range(trees))
    context = rows.sparkSession.sparkContext
    kinds = context._jvm.org.apache.spark.ml.classification
    held = context._gateway.new_array(kinds.DecisionTreeClassificationModel, trees)
    for i, one in enumerate(fitted):
        held[i] = one
    java = kinds.RandomForestClassificationModel(f"forest_{seed}", held, len(names), len(classes["ml_attr"]["vals"]))
    java.set(java.getParam("numTrees"), trees)
    forest = RandomForestClassificationModel(java)
    return PipelineModel([*prepared, bins, VectorAssembler(inputCols=list(names), outputCol="features"), forest])
