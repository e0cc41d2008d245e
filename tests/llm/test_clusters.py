import numpy as np
from pyspark.sql import functions as F

from marketloom.llm.clusters import Mixture, cluster_profiles, fit_mixtures, similarity_clusters

SCHEMA = "id bigint, product_name string, keywords array<string>, description string, x array<float>, cluster int, product_id string"


def test_em_against_plain_numpy(spark):
    rng = np.random.default_rng(0)
    centres = np.array([[0, 0], [6, 0], [0, 6]])
    data = np.concatenate([c + rng.normal(size=(200, 2)) for c in centres]).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(data)], "product_id long, x array<float>").repartition(5)
    models, bic = fit_mixtures(df, (1, 3, 6), 12, 0.01)
    assert min(bic, key=bic.get) == 3
    m = models[3]
    got = sorted(m.means.round(0).tolist())
    assert got == [[0, 0], [0, 6], [6, 0]] or np.allclose(np.sort(m.means, 0), np.sort(centres, 0), atol=0.4)
    assert np.allclose(m.weights.sum(), 1) and np.allclose(m.weights, 1 / 3, atol=0.05)
    # one more expectation over all rows in one place gives the same likelihood as the distributed passes
    joint = m.log_joint(data.astype(float))
    top = joint.max(1)
    likelihood = (top + np.log(np.exp(joint - top[:, None]).sum(1))).sum()
    assert np.isclose(bic[3], -2 * likelihood + m.free_parameters * np.log(len(data)))


def test_regularised_covariance_of_copies(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)], "product_id long, x array<float>")
    models, bic = fit_mixtures(df, (2, 4), 5, 0.02)
    assert all(np.isfinite(v) for v in bic.values())
    assert all(isinstance(m, Mixture) and (np.linalg.eigvalsh(m.covariances) > 0).all() for m in models.values())


def test_topics_are_found(spark):
    topics = {"bread": "flour oven loaf dough", "ink": "needle stencil tattoo session", "garden": "compost crate seed bed"}
    rows = []
    for i in range(240):
        name = list(topics)[i % 3]
        words = topics[name].split()
        rows.append((i, f"{name} {words[i % 4]} planner", [words[(i + 1) % 4], name], " ".join(words) if i % 5 else None, None, 7, "clash"))
    rows += [(1000, None, None, None, None, 7, "clash"), (1001, "", [], "", None, 7, "clash"), (1002, "bread " * 20_000, [None], None, None, 7, "clash"), (None, "bread", None, None, None, 7, "clash")]
    df = spark.createDataFrame(rows, SCHEMA)
    members = similarity_clusters(df, (3, 6), 10).cache()
    got = {r.product_id: r.cluster for r in members.collect()}
    assert set(got) == set(range(240)) | {1000, 1001, 1002} and got[1000] == got[1001]
    for t in range(3):
        own = [got[i] for i in range(t, 240, 3)]
        others = {got[i] for i in range(240) if i % 3 != t}
        assert not set(own) & others  # no cluster mixes topics
    profiles = cluster_profiles(members, 3).collect()
    assert sum(p["size"] for p in profiles) == 243
    density = {r.product_id: r.log_density for r in members.collect()}
    for p in profiles:
        inside = sorted((i for i in got if got[i] == p["cluster"]), key=lambda i: (-density[i], i))
        assert p.typical_ids == inside[:3]
    assert similarity_clusters(df.where(F.lit(False))).count() == 0


def test_criterion_decides_beyond_the_largest_number_given(spark):
    rng = np.random.default_rng(3)
    data = np.concatenate([np.array([9 * (i % 4), 9 * (i // 4)]) + rng.normal(size=(60, 2)) for i in range(12)])
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(data)], "product_id long, x array<float>")
    models, bic = fit_mixtures(df, (2, 4), 12, 0.01)
    assert min(bic, key=bic.get) == 12 and set(models) == set(bic) == {2, 4, 6, 8, 12, 16}


def test_criterion_decides_on_small_input_too(spark):
    rng = np.random.default_rng(4)
    data = np.concatenate([np.array([9 * i, 9 * (i % 2)]) + rng.normal(size=(20, 2)) for i in range(3)])
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(data)], "product_id long, x array<float>")
    _, bic = fit_mixtures(df, (3, 8), 12, 0.01)
    assert min(bic, key=bic.get) == 3 and set(bic) == {1, 3, 8}
    _, bic = fit_mixtures(df, (12,), 12, 0.01)
    assert set(bic) == {1, 3, 6, 12, 16} and min(bic, key=bic.get) == 3
    _, bic = fit_mixtures(df.limit(1), (8,), 3, 0.01)
    assert set(bic) == {1}
