import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators.decomposition import explained_variance, fit_pca, with_vector
from tidemark.operators.labels import binarised, encode_labels, label_classes, mapped_code, merge_labels
from tidemark.operators.neighbours import nearest_in_class
from tidemark.operators.preprocess import MISSING, fit_preprocessor, one_hot_long, scaler_stats
from tidemark.operators.sampling import mock_predictions, stratified_folds, stratified_split
from tidemark.operators.smote import oversample


@pytest.fixture(scope="module")
def train(spark):
    rows = [(1.0, 5, "b", "q", True), (3.0, 5, "a", None, False), (None, 5, "c", "p", True), (8.0, 5, "a", "p", True)]
    return spark.createDataFrame(rows, "x double, k int, `c-1` string, d string, f boolean")


def test_scaler_population_deviation_and_constants(train):
    rows = {r["column"]: r for r in scaler_stats(train, ["x", "k"]).collect()}
    assert rows["x"]["std"] == pytest.approx(np.std([1, 3, 8])) and rows["x"]["mean"] == 4.0
    assert rows["k"]["scale"] == 1.0 and rows["k"]["std"] == 0.0


def test_encoder_drops_first_and_ignores_unknown(spark, train):
    fitted = fit_preprocessor(train)
    assert fitted.categories == {"c-1": ["a", "b", "c"], "d": ["p", "q", MISSING], "f": ["false", "true"]}
    assert fitted.feature_names == ["x", "k", "c-1_b", "c-1_c", "d_q", "d_nan", "f_true"]
    other = spark.createDataFrame(
        [(4.0, 6, "zz", None, None), (1.0, 5, "c", "q", True)], "x double, k int, `c-1` string, d string, f boolean"
    )
    wide = [list(r) for r in fitted.encoded_frame(other, generic=True).collect()]
    assert wide[0] == [0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0]
    assert wide[1][2:] == [0.0, 1.0, 1.0, 0.0, 1.0]
    vectors = fitted.pipeline_model(train).transform(other).select(vector_to_array("features").alias("v")).collect()
    assert [list(r["v"]) for r in vectors] == wide


def test_pipeline_saves_and_loads(train, tmp_path):
    model = fit_preprocessor(train).pipeline_model(train)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    pick = lambda m: [list(r[0]) for r in m.transform(train.dropna(subset=["x"])).select(vector_to_array("features")).collect()]
    assert pick(model) == pick(again)


def test_one_hot_long_matches_the_wide_form(spark, train):
    keyed = train.withColumn("id", F.monotonically_increasing_id()).cache()
    long = {(r["id"], r["slot"]) for r in one_hot_long(keyed, "id", ["c-1", "d", "f"]).collect()}
    fitted = fit_preprocessor(keyed, ("id", "x", "k"))
    wide = keyed.select("id").collect(), fitted.encoded_frame(keyed).collect()
    assert long == {(k["id"], i) for k, row in zip(*wide) for i, v in enumerate(row) if v == 1.0}


def test_labels(spark):
    df = spark.createDataFrame([(">30",), ("<30",), ("NO",), ("other",), (None,)], "y string")
    merged = [r["y"] for r in merge_labels(df, "y").collect()]
    assert merged == ["YES", "YES", "NO", "other", None]
    row = [tuple(r) for r in merge_labels(df, "y").select(binarised(F.col("y")), mapped_code(F.col("y"))).collect()]
    assert row == [(1, 1), (1, 1), (0, 0), (0, None), (0, None)]
    classes = label_classes(df, "y")
    assert [r["y"] for r in classes.orderBy("class_id").collect()] == ["<30", ">30", "NO", "other"]
    unseen = encode_labels(spark.createDataFrame([("new",), ("NO",)], "y string"), "y", classes)
    assert {r["y"]: r["class_id"] for r in unseen.collect()} == {"new": None, "NO": 2}


def test_split_and_folds_keep_class_sizes(spark):
    rows = [(i, "a" if i % 10 < 7 else ("b" if i % 10 < 9 else "c")) for i in range(1003)]
    df = spark.createDataFrame(rows, "id bigint, y string")
    parted = stratified_split(df, ["id"], "y", 0.2)
    sizes = {(r["y"], r["split"]): r["count"] for r in parted.groupBy("y", "split").count().collect()}
    counts = {y: sum(1 for _, v in rows if v == y) for y in "abc"}
    assert sum(n for (_, s), n in sizes.items() if s == "test") == 201
    for y, n in counts.items():
        assert sizes[(y, "train")] + sizes[(y, "test")] == n
        assert abs(sizes[(y, "train")] - n * 802 / 1003) < 1
    again = stratified_split(df.repartition(11), ["id"], "y", 0.2)
    assert parted.exceptAll(again).count() == 0
    assert parted.exceptAll(stratified_split(df, ["id"], "y", 0.2, seed=7)).count() > 0

    folds = stratified_folds(df, ["id"], "y", 5)
    per = {(r["y"], r["fold"]): r["count"] for r in folds.groupBy("y", "fold").count().collect()}
    start = 0
    for y in "abc":
        want = [sum(1 for p in range(start, start + counts[y]) if p % 5 == i) for i in range(5)]
        assert [per.get((y, i), 0) for i in range(5)] == want
        start += counts[y]


def test_fewer_rows_than_folds(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id bigint, y string")
    assert sorted(r["fold"] for r in stratified_folds(df, ["id"], "y", 5).collect()) == [0, 1, 2]


def test_mock_scores_look_like_beta_2_5(spark):
    df = mock_predictions(spark.range(20000), ["id"], 42).agg(F.avg("pred_readmit"), F.var_pop("pred_readmit")).first()
    assert df[0] == pytest.approx(2 / 7, abs=0.01) and df[1] == pytest.approx(10 / 392, abs=0.002)


@pytest.mark.parametrize("rows_per_block", [4096, 40])
def test_neighbours_equal_brute_force(spark, rows_per_block):
    r = np.random.default_rng(9)
    data = [(int(c), f"{i:032x}", v) for i, (c, v) in enumerate(zip(r.integers(0, 2, 300), r.normal(size=(300, 4)) + 6 * r.integers(0, 3, (300, 1))))]
    df = spark.createDataFrame(
        [(c, i, [float(x) for x in v], n % 3 == 0) for n, (c, i, v) in enumerate(data)],
        "label int, id string, vec array<double>, is_query boolean",
    )
    got = {}
    for row in nearest_in_class(df, 5, rows_per_block).collect():
        got.setdefault(row["qid"], {})[row["rank"]] = row["nid"]
    want = {}
    for n, (c, i, v) in enumerate(data):
        if n % 3 == 0:
            others = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for cc, j, w in data if cc == c and j != i)
            want[i] = {k + 1: j for k, (_, j) in enumerate(others[:5])}
    assert got == want


@pytest.mark.parametrize("rows_per_block", [4096, 16])
def test_oversampling(spark, rows_per_block):
    r = np.random.default_rng(4)
    big = [("NO", v) for v in r.normal(size=(150, 3))]
    small = [("YES", v) for v in r.normal(size=(40, 3)) + 3] + [("YES", np.array([9.0, 9.0, 9.0]))] * 21
    df = spark.createDataFrame(
        [(i, y, [float(x) for x in v]) for i, (y, v) in enumerate(big + small)], "id bigint, y string, a array<double>"
    )
    out = oversample(with_vector(df, "a"), "id", "y", rows_per_block=rows_per_block).select(
        "y", "synthetic", vector_to_array("features").alias("v")
    ).collect()
    assert sum(x["y"] == "YES" for x in out) == sum(x["y"] == "NO" for x in out) == 150
    made = [np.array(x["v"]) for x in out if x["synthetic"]]
    assert len(made) == 150 - 61
    real = np.array([v for y, v in big + small if y == "YES"])
    gap = np.linalg.norm(real[:, None] - real[None], axis=2)
    np.fill_diagonal(gap, np.inf)
    near = np.argsort(gap, axis=1, kind="stable")[:, :5]
    reach = np.sort(gap, axis=1)[:, 4]
    for p in made:
        ok = False
        for i, base in enumerate(real):
            for j in [j for j in range(len(real)) if j != i and gap[i, j] <= reach[i] + 1e-9]:
                step = real[j] - base
                t = 0.0 if not step.any() else float((p - base) @ step / (step @ step))
                ok |= -1e-9 <= t <= 1 + 1e-9 and np.allclose(base + t * step, p, atol=1e-9)
        assert ok
    assert near.shape[1] == 5


def test_too_small_class_is_refused(spark):
    df = spark.createDataFrame([(i, int(i < 3), [float(i)]) for i in range(20)], "id int, y int, a array<double>")
    with pytest.raises(ValueError):
        oversample(with_vector(df, "a"), "id", "y")


def test_pca_is_centred(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(200, 4)) * [5, 2, 1, 0.1] + 100
    df = with_vector(spark.createDataFrame([([float(v) for v in row],) for row in x], "a array<double>"), "a")
    model = fit_pca(df, 2)
    ratios = [r["ratio"] for r in explained_variance(spark, model).orderBy("component").collect()]
    eigen = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert ratios == pytest.approx(list(eigen[:2] / eigen.sum()), abs=1e-9)
    means = model.transform(df).select(vector_to_array("pca").alias("p")).agg(F.avg(F.col("p")[0])).first()[0]
    assert abs(means) < 1e-9
