"""Similarity clusters of listings: a Gaussian mixture fitted by expectation-maximisation over reduced text features."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.session import staged

BUCKETS = 4096  # hashed words
SKETCH = 256  # signed sums of buckets
DIMENSIONS = 20  # principal components
COMPONENTS = (8, 16, 32, 64)  # tried first; larger and smaller ones follow while the last has the lowest criterion
ITERATIONS = 15  # at most; a mixture whose likelihood hardly rises any more is left as it is
SETTLED = 2e-4  # relative rise of the log-likelihood below which it is
RIDGE = 0.02  # added to the diagonal of every covariance of standardised features
SEEDS = 4_000  # rows the first means are drawn from; every other statistic covers all rows
FIELD_WEIGHTS = {"product_name": 2.0, "keywords": 2.0, "description": 1.0}

def _hashes(text: str) -> Column:
    """The bucket of every word of a text column, as often as it occurs."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"\p{L}+"), 0)
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def hashed_words(products: DataFrame) -> DataFrame:
    """product_id, buckets, weights: hashed words of name, keywords and description with damped counts.

    Only letters count; words are weighed by the field they stand in. A row without a word has empty arrays. Words are
    found and hashed by built-in functions; counting them is one sort of numbers per batch.
    """
    factors = list(FIELD_WEIGHTS.values())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, worth = [], []
            for factor, lists in zip(factors, batch.columns[1:]):
                keys.append(np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy())) * BUCKETS + lists.flatten().to_numpy())
                worth.append(np.full(len(keys[-1]), factor))
            once, at = np.unique(np.concatenate(keys), return_inverse=True)
            weights = 1 + np.log(np.bincount(at, np.concatenate(worth), minlength=len(once)))
            ends = np.searchsorted(once, np.arange(batch.num_rows + 1) * BUCKETS).astype(np.int32)
            lists = lambda v, k: pa.ListArray.from_arrays(pa.array(ends), pa.array(v, k))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists((once % BUCKETS).astype(np.int32), pa.int32()), lists(weights.astype(np.float32), pa.float32())], names=["product_id", "buckets", "weights"])

    rows = products.where("id is not null").select(F.col("id").cast("long").alias("product_id"), "product_name", F.concat_ws(" ", "keywords").alias("keywords"), "description")
    return rows.select("product_id", *(_hashes(f) for f in FIELD_WEIGHTS)).mapInArrow(count, "product_id long, buckets array<int>, weights array<float>")


def _sketcher(idf: np.ndarray):
    """Rows of hashed words -> a dense matrix of unit vectors: each bucket adds its signed weight in two places."""
    rng = np.random.default_rng(11)
    places, signs = rng.integers(0, SKETCH, (BUCKETS, 2)), rng.choice((-1.0, 1.0), (BUCKETS, 2))

    def sketch(batch: pa.RecordBatch) -> np.ndarray:
        lists = batch.column(1)
        row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
        b = lists.flatten().to_numpy()
        w = batch.column(2).flatten().to_numpy() * idf[b]
        out = np.zeros(batch.num_rows * SKETCH)
        for k in range(2):
            out += np.bincount(row * SKETCH + places[b, k], w * signs[b, k], minlength=len(out))
        out = out.reshape(-1, SKETCH)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    return sketch


def _summed(rows: DataFrame) -> DataFrame:
    """Sums of the vectors `v` (double as binary) per `part`: one partial sum a partition comes in, one row a part goes out."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in table.column("v"))
        return pa.table({"part": table.column("part")[:1], "v": pa.array([total.tobytes()], pa.binary())})

    return rows.groupBy("part").applyInArrow(add, "part long, v binary")


def reduced_features(products: DataFrame) -> DataFrame:
    """product_id, x: first principal components of the standardised sketches of every product's tf-idf vector.

    The components keep their relative spread; the first has variance one.
    """
    words = staged(hashed_words(products), "cluster-words")
    n = max(words.count(), 1)
    seen = words.select(F.explode("buckets").alias("b")).groupBy("b").count().collect()  # at most BUCKETS rows
    idf = np.zeros(BUCKETS)
    for b, c in seen:
        idf[b] = math.log((n + 1) / (c + 1)) + 1
    sketch = _sketcher(idf)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, ss = np.zeros(SKETCH), np.zeros((SKETCH, SKETCH))
        for batch in batches:
            x = sketch(batch)
            s += x.sum(0)
            ss += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([np.concatenate((s, ss.ravel())).tobytes()], pa.binary())], names=["part", "v"])

    total = np.frombuffer(bytes(_summed(words.mapInArrow(moments, "part long, v binary")).first()["v"]))
    mean = total[:SKETCH] / n
    covariance = total[SKETCH:].reshape(SKETCH, SKETCH) / n - np.outer(mean, mean)
    deviation = np.sqrt(np.maximum(np.diagonal(covariance), 1e-12))
    values, vectors = np.linalg.eigh(covariance / np.outer(deviation, deviation))
    top = np.argsort(values)[::-1][:DIMENSIONS]
    signed = vectors[:, top] * np.sign(vectors[np.abs(vectors[:, top]).argmax(0), np.arange(len(top))])
    axes = signed / deviation[:, None] / math.sqrt(max(values[top[0]], 1e-12))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = ((sketch(batch) - mean) @ axes).astype(np.float32)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(x.ravel(), pa.float32()))], names=["product_id", "x"])

    return words.mapInArrow(project, "product_id long, x array<float>")


def _monomials(x: np.ndarray) -> np.ndarray:
    """1, the features, and their products two by two: the log density of every component is linear in these."""
    i, j = np.triu_indices(x.shape[1])
    return np.concatenate((np.ones((len(x), 1)), x, x[:, i] * x[:, j]), axis=1)


class Mixture:
    """Weights, means and covariances of a Gaussian mixture."""

    def __init__(self, weights: np.ndarray, means: np.ndarray, covariances: np.ndarray):
        self.weights, self.means, self.covariances = weights, means, covariances
        inverse = np.linalg.inv(np.linalg.cholesky(covariances))
        constant = np.log(np.maximum(weights, 1e-300)) + np.log(np.abs(np.diagonal(inverse, axis1=1, axis2=2))).sum(1) - means.shape[1] / 2 * math.log(2 * math.pi)
        precision = inverse.transpose(0, 2, 1) @ inverse
        linear = np.einsum("kij,kj->ki", precision, means)
        i, j = np.triu_indices(means.shape[1])
        square = -0.5 * np.where(i == j, 1.0, 2.0) * precision[:, i, j]
        self.coefficients = np.concatenate((constant[:, None] - 0.5 * (linear * means).sum(1)[:, None], linear, square), axis=1).T

    def log_joint(self, x: np.ndarray) -> np.ndarray:
        """Log of weight and density of every component at every row, by one matrix product."""
        return _monomials(x) @ self.coefficients

    @property
    def free_parameters(self) -> int:
        k, d = self.means.shape
        return k * (d + d * (d + 1) // 2) + k - 1


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(1).flatten().to_numpy().astype(float).reshape(batch.num_rows, -1)


def _log_sum(a: np.ndarray) -> np.ndarray:
    top = a.max(1)
    return top + np.log(np.exp(a - top[:, None]).sum(1))


def _rows_at_once(components: int) -> int:
    """Rows whose matrix of densities takes 2 MB, 64 at least."""
    return max(64, min(4096, 262_144 // components))


def _first_mixture(seeds: np.ndarray, k: int, trials: int = 8, rounds: int = 10) -> Mixture:
    """k means spread over the seeds, equal weights, unit covariances.

    Each mean is the best of some draws in proportion to the squared distance from those before (k-means++ with a fixed
    seed); a few rounds of k-means on the seeds follow.
    """
    rng = np.random.default_rng(k)
    means = seeds[rng.integers(len(seeds))][None]
    distance = ((seeds - means[0]) ** 2).sum(1)
    while len(means) < k:
        total = distance.sum()
        drawn = rng.choice(len(seeds), trials, p=distance / total) if total > 0 else np.array([len(means) % len(seeds)])
        options = np.minimum(distance, ((seeds[:, None] - seeds[drawn]) ** 2).sum(2).T)
        best = options.sum(1).argmin()
        means, distance = np.vstack((means, seeds[drawn[best]])), options[best]
    for _ in range(rounds):
        nearest = np.concatenate([(-2 * s @ means.T + (means**2).sum(1)).argmin(1) for s in np.array_split(seeds, -(-len(seeds) // 4096))])
        n = np.bincount(nearest, minlength=k)
        sums = np.stack([np.bincount(nearest, seeds[:, d], minlength=k) for d in range(seeds.shape[1])], axis=1)
        means = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], means)
    d = seeds.shape[1]
    return Mixture(np.full(k, 1 / k), means, np.repeat(np.eye(d)[None], k, 0))


def _next_components(k: int) -> int:
    """The number of components tried after k: 64, 96, 128, 192, 256 and so on."""
    return k + (1 << max(k.bit_length() - 2, 0))


def fit_mixtures(features: DataFrame, components: tuple[int, ...], iterations: int, ridge: float, seeds: int = SEEDS) -> tuple[dict[int, Mixture], dict[int, float]]:
    """Mixtures and Bayesian information criteria by number of components, those given fitted in the same passes over all rows.

    While the largest number has the lowest criterion the next larger one below the number of rows is fitted, while the
    smallest has it half of that, so the criterion and not the list decides. Each pass sends the mixtures to the tasks and brings back one row of sums per component, whatever the number
    of rows.
    """
    n = features.count()
    if not n:
        return {}, {}
    models, bic = _fitted(features, n, tuple(k for k in components if k < n) or (1,), iterations, ridge, seeds)
    best = lambda: min(bic, key=lambda k: (bic[k], k))
    while best() == max(bic) and (k := _next_components(max(bic))) < n or best() == min(bic) and (k := min(bic) // 2):
        for known, more in zip((models, bic), _fitted(features, n, (k,), iterations, ridge, seeds)):
            known.update(more)
    return models, bic


def _fitted(features: DataFrame, n: int, components: tuple[int, ...], iterations: int, ridge: float, seeds: int) -> tuple[dict[int, Mixture], dict[int, float]]:
    """Mixtures and criteria of exactly these numbers of components; ten seeds a component at least."""
    wanted = max(seeds, 10 * max(components))
    first = np.array([r["x"] for r in features.orderBy(F.xxhash64("product_id"), "product_id").select("x").limit(wanted).collect()], float)
    models = {k: _first_mixture(first, k) for k in components}
    d = first.shape[1]
    chunk = _rows_at_once(sum(components))
    bic: dict[int, float] = {}
    likelihood: dict[int, float] = {}
    for step in range(iterations + 1):
        current = {k: m for k, m in models.items() if k not in bic}
        if not current:
            break

        def expect(batches: Iterator[pa.RecordBatch], current: dict[int, Mixture] = current) -> Iterator[pa.RecordBatch]:
            coefficients = np.concatenate([m.coefficients for m in current.values()], axis=1)
            parts = np.split(np.arange(coefficients.shape[1]), np.cumsum(list(current))[:-1])
            sums, likelihoods = np.zeros(coefficients.shape[::-1]), np.zeros(len(current))
            for batch in batches:
                for begin in range(0, batch.num_rows, chunk):
                    terms = _monomials(_matrix(batch.slice(begin, chunk)))
                    joint = terms @ coefficients
                    for n, own in enumerate(parts):  # each model's share of every row
                        density = _log_sum(joint[:, own])
                        likelihoods[n] += density.sum()
                        joint[:, own] = np.exp(joint[:, own] - density[:, None])
                    sums += joint.T @ terms
            names, vectors = [], []
            for n, (k, own) in enumerate(zip(current, parts)):
                names += [(k << 32) + c for c in range(k)]
                vectors += [np.concatenate(([likelihoods[n] if c == 0 else 0.0], sums[row])).tobytes() for c, row in enumerate(own)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(vectors, pa.binary())], names=["part", "v"])

        got = {r["part"]: np.frombuffer(bytes(r["v"])) for r in _summed(features.mapInArrow(expect, "part long, v binary")).collect()}
        for k in current:
            rows = np.array([got[(k << 32) + c] for c in range(k)])
            last, likelihood[k] = likelihood.get(k), rows[0, 0]
            if step == iterations or last is not None and abs(likelihood[k] - last) <= SETTLED * abs(last):
                bic[k] = -2 * rows[0, 0] + models[k].free_parameters * math.log(n)
            else:
                models[k] = _maximised(models[k], rows[:, 1:], d, ridge)
    return models, bic


def _maximised(model: Mixture, sums: np.ndarray, d: int, ridge: float) -> Mixture:
    """The mixture of the sums of shares, of shared features and of shared products; a component without rows stays where it is."""
    mass = np.maximum(sums[:, 0], 1e-9)
    means = sums[:, 1 : 1 + d] / mass[:, None]
    i, j = np.triu_indices(d)
    second = np.empty((len(mass), d, d))
    second[:, i, j] = second[:, j, i] = sums[:, 1 + d :] / mass[:, None]
    covariances = second - means[:, :, None] * means[:, None, :]
    empty = sums[:, 0] < 1.0
    means[empty], covariances[empty] = model.means[empty], np.eye(d)
    return Mixture(mass / mass.sum(), means, covariances + ridge * np.eye(d))


def similarity_clusters(products: DataFrame, components: tuple[int, ...] = COMPONENTS, iterations: int = ITERATIONS, ridge: float = RIDGE) -> DataFrame:
    """product_id, cluster, probability, log_density for every product with an id.

    Features are the first principal components of the standardised sketch of tf-idf weighted words of name, keywords and
    description; the number of components of the mixture is the one with the lowest Bayesian information criterion, larger
    and smaller ones than those given being tried for as long as the last has the lowest; a
    product belongs to the component most likely to have made it, `log_density` is its log density there. Clusters are
    numbered from 0 by falling weight. NULL and empty texts are rows without words and lie together; copies get the
    same cluster; very long texts are read whole; an empty table gives an empty result; only the columns named are read.
    """
    schema = "product_id long, cluster int, probability double, log_density double"
    features = staged(reduced_features(products), "cluster-features")
    models, bic = fit_mixtures(features, components, iterations, ridge)
    if not models:
        return products.sparkSession.createDataFrame([], schema)
    model = models[min(bic, key=lambda k: (bic[k], k))]
    order = np.argsort(-model.weights, kind="stable")
    model = Mixture(model.weights[order], model.means[order], model.covariances[order])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _rows_at_once(len(model.weights))
        for batch in batches:
            for part in (batch.slice(begin, chunk) for begin in range(0, batch.num_rows, chunk)):
                joint = model.log_joint(_matrix(part))
                best = joint.argmax(1)
                own = joint[np.arange(len(best)), best]
                columns = [part.column(0), pa.array(best.astype(np.int32)), pa.array(np.exp(own - _log_sum(joint))), pa.array(own - np.log(model.weights[best]))]
                yield pa.RecordBatch.from_arrays(columns, names=["product_id", "cluster", "probability", "log_density"])

    return features.mapInArrow(assign, schema)


def cluster_profiles(members: DataFrame, typical: int = 5, parts: int = 64) -> DataFrame:
    """cluster, size, mean_probability, typical_ids (densest members first; ties to the lower id).

    The densest of each cluster are found among the densest of its parts, so a cluster of any size is ranked in pieces.
    """
    order = [F.col("log_density").desc(), F.col("product_id")]
    salt = F.pmod(F.xxhash64("product_id"), F.lit(parts))
    dense = members.withColumn("salt", salt).withColumn("r", F.row_number().over(W.partitionBy("cluster", "salt").orderBy(*order))).where(F.col("r") <= typical)
    dense = dense.withColumn("r", F.row_number().over(W.partitionBy("cluster").orderBy(*order))).where(F.col("r") <= typical)
    typical_ids = dense.groupBy("cluster").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "product_id"))), lambda x: x["product_id"]).alias("typical_ids"))
    sizes = members.groupBy("cluster").agg(F.count("*").alias("size"), F.avg("probability").alias("mean_probability"))
    return sizes.join(typical_ids, "cluster").select("cluster", "size", "mean_probability", "typical_ids")
