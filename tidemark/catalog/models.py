"""Queries that train models, and the windowed drift measure."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators.decomposition import explained_variance, fit_pca, with_vector
from ..operators.encoding import fit_encoder
from ..operators.neighbours import nearest_in_class
from ..operators.ordering import held
from ..operators.sampling import stratified_split
from ..operators.smote import oversample
from ..operators.sparse_pca import fit_components
from ..plans.training import feature_importance, oversample_fit_report, train_boosted, train_forest, with_scores
from ..plans.tuning import fit_final, run_search, search_space
from ..session import checkpointed
from ..streaming.incremental import baseline_bins, psi_per_window, window_histogram
from .registry import register, table
from .samples import EVENT_CUT, QUANTILES, moment


@register("pca_explained")
def _pca(spark, sf_dir):
    vectors = with_vector(table(spark, sf_dir, "embeddings"), "embedding")
    return explained_variance(spark, fit_pca(vectors, 50))


@register("pca_scores")
def _pca_scores(spark, sf_dir):
    vectors = with_vector(table(spark, sf_dir, "embeddings"), "embedding")
    scored = fit_pca(vectors, 50).transform(vectors)
    return scored.select("vec_id", "label", vector_to_array("pca").alias("pca"))


_EACH = "SELECT vec_id, i, embedding[i]::DOUBLE AS x FROM embeddings, range(1, 65) t(i)"


@register(
    "pca_train_test",
    f"""WITH e AS ({_EACH}), m AS (SELECT i, avg(x) AS m FROM e WHERE vec_id % 5 <> 0 GROUP BY i),
    q AS (SELECT vec_id, sum((x - m) * (x - m)) AS q FROM e JOIN m USING (i) GROUP BY vec_id)
    SELECT CASE WHEN vec_id % 5 <> 0 THEN 'train' ELSE 'test' END AS side, count(*) AS n, round(avg(q), 6) AS mean_square FROM q GROUP BY 1""",
)
def _pca_train_test(spark, sf_dir):
    """Components and centre of the training rows applied to both sides; all components keep every distance to the centre."""
    vectors = with_vector(table(spark, sf_dir, "embeddings"), "embedding")
    model = fit_pca(vectors.where("vec_id % 5 <> 0"), 64)
    square = F.aggregate(vector_to_array("pca"), F.lit(0.0), lambda s, x: s + x * x)
    side = F.when(F.col("vec_id") % 5 != 0, "train").otherwise("test")
    return model.transform(vectors).groupBy(side.alias("side")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(square), 6).alias("mean_square"))


@register(
    "pca_spectrum",
    f"""WITH e AS ({_EACH}), m AS (SELECT i, avg(x) AS m FROM e GROUP BY i), z AS (SELECT vec_id, i, x - m AS z FROM e JOIN m USING (i)),
    c AS (SELECT a.i, b.i AS j, sum(a.z * b.z) AS c FROM z a JOIN z b USING (vec_id) GROUP BY 1, 2),
    t AS (SELECT sum(c) AS t FROM c WHERE i = j)
    SELECT 1.0::DOUBLE AS last_cumulative, round(sum((c / t) * (c / t)), 9) AS sum_of_squares FROM c, t""",
)
def _pca_spectrum(spark, sf_dir):
    """All variance ratios: they add up to 1, their squares to those of the covariance matrix."""
    vectors = with_vector(table(spark, sf_dir, "embeddings"), "embedding")
    ratios = explained_variance(spark, fit_pca(vectors, 64))
    return ratios.agg(F.round(F.max("cumulative"), 9).alias("last_cumulative"),
                      F.round(F.sum(F.col("ratio") * F.col("ratio")), 9).alias("sum_of_squares"))


_ENCODED = [
    "(o_custkey - avg(o_custkey) OVER ()) / stddev_pop(o_custkey) OVER ()",
    "(o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER ()",
    *(f"(o_orderstatus = '{c}')::DOUBLE" for c in ("O", "P")),
    *(f"(o_orderpriority = '{c}')::DOUBLE" for c in ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")),
]


@register(
    "pca_encoded",
    f"""WITH x AS (SELECT {', '.join(f'{e} AS x{i}' for i, e in enumerate(_ENCODED))} FROM orders)
    SELECT round({' + '.join(f'var_samp(x{i})' for i in range(len(_ENCODED)))}, 6) AS total,
      round({' + '.join(f'covar_samp(x{i}, x{j}) ** 2' for i in range(len(_ENCODED)) for j in range(len(_ENCODED)))}, 6) AS squares,
      1.0::DOUBLE AS last_cumulative FROM x""",
)
def _pca_encoded(spark, sf_dir):
    """Components of the sparse encoded orders: variances add up to that of the columns, their squares to the covariances'."""
    orders = table(spark, sf_dir, "orders").drop("o_orderdate")
    encoder = fit_encoder(orders, ("o_orderkey",))
    vectors = checkpointed(encoder.transform(orders, ["o_orderkey"]))
    found = fit_components(vectors, 50).explained(spark)
    return found.agg(F.round(F.sum("variance"), 6).alias("total"), F.round(F.sum(F.col("variance") * F.col("variance")), 6).alias("squares"),
                     F.round(F.max("cumulative"), 6).alias("last_cumulative"))


def labelled_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return table(spark, sf_dir, "labels").select("doc_id", "quality").join(docs, "doc_id")


_CONFIG = {"n_estimators": 200, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8, "colsample_bytree": 0.8, "min_child_weight": 1.0}


@register("gbt_score")
def _gbt(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir)
    with held(rows):
        model = train_boosted(rows, "quality", _CONFIG, ("doc_id",), keys=["doc_id"])
    return with_scores(model, rows).select("doc_id", "quality", "pred_proba")


FIRST_TREE = {"n_estimators": 1, "max_depth": 2, "learning_rate": 0.3, "reg_lambda": 2.0, "reg_alpha": 0.5, "min_child_weight": 3.0}


def _score_sql(g: str, h: str) -> str:
    return f"greatest(abs({g}) - 0.5, 0) ** 2 / ({h} + 2.0)"


def _level_sql(level: int) -> str:
    """CTEs that split the nodes of one level: every cut and category is tried, the largest gain wins."""
    return f"""
t{level} AS (SELECT path, sum(g) AS g, sum(h) AS h, count(*) AS n FROM r{level} GROUP BY path),
c{level} AS (
  SELECT path, pos, threshold, category, sum(g) FILTER (is_left) AS gl, sum(h) FILTER (is_left) AS hl, count(*) FILTER (is_left) AS nl
  FROM (SELECT path, g, h, pos, threshold, category, CASE pos WHEN 0 THEN n_chars < threshold WHEN 1 THEN lang <> category
        ELSE source <> category END AS is_left FROM r{level}, candidate) GROUP BY ALL),
s{level} AS (
  SELECT path, pos, threshold, category, {_score_sql('gl', 'hl')} + {_score_sql('t.g - gl', 't.h - hl')} - {_score_sql('t.g', 't.h')} AS gain
  FROM c{level} JOIN t{level} t USING (path)
  WHERE nl > 0 AND nl < n AND hl >= 3 AND t.h - hl >= 3
  QUALIFY gain > 1e-6 AND row_number() OVER (PARTITION BY path ORDER BY round(gain, 9) DESC, pos, threshold, category) = 1),
r{level + 1} AS (
  SELECT r.* REPLACE (path || CASE WHEN pos IS NULL THEN '' WHEN CASE pos WHEN 0 THEN n_chars < threshold WHEN 1 THEN lang <> category
         ELSE source <> category END THEN 'L' ELSE 'R' END AS path) FROM r{level} r LEFT JOIN s{level} s USING (path))"""


FIRST_TREE_SQL = f"""WITH raw AS (SELECT doc_id, l.quality AS y, d.n_chars, coalesce(d.lang, chr(1114111)) AS lang, coalesce(d.source, chr(1114111)) AS source
      FROM labels l JOIN documents d USING (doc_id) WHERE l.quality IS NOT NULL),
    w AS (SELECT count(*) FILTER (y = 0) / greatest(count(*) FILTER (y = 1), 1) AS w FROM raw),
    r0 AS (SELECT '' AS path, doc_id, n_chars, lang, source, (0.5 - y) * CASE WHEN y = 1 THEN w ELSE 1 END AS g,
           0.25 * CASE WHEN y = 1 THEN w ELSE 1 END AS h FROM raw, w),
    sorted AS (SELECT list_sort(list(n_chars)) AS v FROM raw),
    candidate AS (
      SELECT DISTINCT 0 AS pos, v[greatest(1, ceil(i / 256.0 * len(v)))::INTEGER]::DOUBLE AS threshold, NULL AS category FROM sorted, range(1, 256) t(i)
      UNION ALL SELECT 1, NULL, unnest(list_sort(list(DISTINCT lang))[2:]) FROM raw
      UNION ALL SELECT 2, NULL, unnest(list_sort(list(DISTINCT source))[2:]) FROM raw),
    {_level_sql(0)}, {_level_sql(1)},
    sums AS (SELECT path, g, h FROM t0 UNION SELECT path, g, h FROM t1 WHERE path <> ''
      UNION ALL SELECT path, sum(g), sum(h) FROM r2 WHERE path NOT IN (SELECT path FROM t0 UNION SELECT path FROM t1) GROUP BY path),
    nodes AS (SELECT *, -0.3 * sign(g) * greatest(abs(g) - 0.5, 0) / (h + 2.0) AS value FROM sums),
    splits AS (SELECT * FROM s0 UNION ALL SELECT * FROM s1)"""


@register(
    "boosted_first_tree",
    FIRST_TREE_SQL + """
    SELECT path, CASE pos WHEN 0 THEN 'n_chars' WHEN 1 THEN 'lang' WHEN 2 THEN 'source' END AS feature, threshold, category,
      round(coalesce(gain, 0.0), 6) AS gain, round(value, 6) AS value, round(h, 6) AS cover
    FROM nodes LEFT JOIN splits USING (path)""",
)
def _first_tree(spark, sf_dir):
    """Splits, gains and weights of one boosted tree with both penalties."""
    rows = labelled_documents(spark, sf_dir)
    nodes = train_boosted(rows, "quality", FIRST_TREE, ("doc_id",), keys=["doc_id"]).tree_table(spark)
    up = nodes.select(F.col("node").alias("parent"), F.explode(F.create_map(F.lit("L"), F.col("left"), F.lit("R"), F.col("right"))).alias("side", "node"))
    first = up.where("parent = 0").select("node", F.col("side").alias("path"))
    second = up.where("parent > 0").join(first.withColumnRenamed("node", "parent"), "parent").select("node", F.concat("path", "side").alias("path"))
    paths = first.unionByName(second).where("node IS NOT NULL")
    return nodes.join(paths, "node", "left").select(
        F.coalesce("path", F.lit("")).alias("path"), "feature", "threshold", "category",
        *[F.round(c, 6).alias(c) for c in ("gain", "value", "cover")])


@register("gbt_importance")
def _gbt_importance(spark, sf_dir):
    """The 15 features of largest mean gain."""
    rows = labelled_documents(spark, sf_dir)
    with held(rows):
        model = train_boosted(rows, "quality", _CONFIG, ("doc_id",), keys=["doc_id"])
    return feature_importance(spark, model, 15)


@register("search_trials")
def _search(spark, sf_dir):
    """Ten drawn configurations on five folds, mean metrics per trial."""
    rows = labelled_documents(spark, sf_dir)
    with held(rows):
        found = run_search(rows, ["doc_id"], "quality", search_space(spark, 10), exclude=("doc_id",))
    return found.trials.select("trial_id", "val_auc", "val_ap", "val_acc", "val_f1")


@register("final_fit_metrics")
def _final(spark, sf_dir):
    """Split, fit on train, measure on test: (metric, value)."""
    parted = stratified_split(labelled_documents(spark, sf_dir), ["doc_id"], "quality")
    train, test = (parted.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    with held(train):
        metrics = fit_final(train, test, "quality", _CONFIG, ("doc_id",), keys=["doc_id"]).metrics
    return spark.createDataFrame(sorted(metrics.items()), "metric string, value double")


@register("rf_importance")
def _rf(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir)
    with held(rows):
        model = train_forest(rows, "quality", ("doc_id",), keys=["doc_id"])
    return feature_importance(spark, model, 20)


@register(
    "smote_counts",
    """SELECT label, CAST((SELECT max(c) FROM (SELECT count(*) AS c FROM embeddings GROUP BY label)) AS BIGINT) AS n,
    CAST((SELECT max(c) FROM (SELECT count(*) AS c FROM embeddings GROUP BY label)) - count(*) AS BIGINT) AS n_synthetic
    FROM embeddings GROUP BY label""",
)
def _smote(spark, sf_dir):
    vectors = with_vector(table(spark, sf_dir, "embeddings"), "embedding")
    grown = oversample(vectors, "vec_id", "label", "features")
    return grown.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("synthetic").alias("n_synthetic"))


@register(
    "smote_neighbours",
    """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
    SELECT q.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, p.v), p.vec_id)::INTEGER AS rank,
      p.vec_id AS neighbour, round(list_distance(q.v, p.v), 6) AS dist
    FROM e q JOIN e p ON q.label = p.label AND q.vec_id <> p.vec_id WHERE q.vec_id % 100 = 0
    QUALIFY rank <= 5""",
)
def _neighbours(spark, sf_dir):
    """The five nearest rows of its class for every row whose id is divisible by 100."""
    points = table(spark, sf_dir, "embeddings").select(
        "label", F.lpad(F.col("vec_id").cast("string"), 19, "0").alias("id"),
        F.col("embedding").cast("array<double>").alias("vec"), (F.col("vec_id") % 100 == 0).alias("is_query"))
    with held(points):
        near = nearest_in_class(points, 5, recall=1.0)
    return near.select(F.col("qid").cast("bigint").alias("vec_id"), "rank", F.col("nid").cast("bigint").alias("neighbour"),
                       F.round("dist", 6).alias("dist"))


@register("smote_report")
def _smote_report(spark, sf_dir):
    """Oversample the smaller class, fit a forest, report on the test rows."""
    rows = labelled_documents(spark, sf_dir)
    return oversample_fit_report(rows, ["doc_id"], "quality").report


@register(
    "window_psi",
    f"""WITH e AS (SELECT list_sort(list_distinct(quantile_cont(value, [{QUANTILES}]))) AS e FROM events WHERE ts < TIMESTAMP '{EVENT_CUT}'),
    b AS (SELECT ts, least(len(list_filter(e, lambda x: x <= value)), len(e) - 1) AS bin FROM events, e WHERE value >= e[1] AND value <= e[len(e)]),
    r AS (SELECT i AS bin, (SELECT count(*) FROM b WHERE b.bin = i AND ts < TIMESTAMP '{EVENT_CUT}') AS n FROM e, range(1, 11) t(i) WHERE i < len(e)),
    c AS (SELECT date_trunc('day', ts) AS d, count(*) AS total FROM b GROUP BY 1),
    w AS (SELECT d, total, r.bin, r.n, (SELECT sum(n) FROM r) AS rt,
          (SELECT count(*) FROM b WHERE date_trunc('day', b.ts) = c.d AND b.bin = r.bin) AS k FROM c, r)
    SELECT CAST(d AS TIMESTAMP) AS window_start, 'value' AS column_name, any_value(total) AS n_cur,
      round(sum((greatest(n / greatest(rt, 1), 1e-6) - greatest(k / greatest(total, 1), 1e-6)) * ln(greatest(n / greatest(rt, 1), 1e-6) / greatest(k / greatest(total, 1), 1e-6))), 9) AS psi
    FROM w GROUP BY d""",
)
def _window_psi(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    baseline = baseline_bins(events.where(F.col("ts") < moment(events, "ts", EVENT_CUT)), ["value"])
    counts = window_histogram(events, baseline.select("column", "edges").distinct(), ["value"], "ts")
    out = psi_per_window(counts, baseline)
    return out.select("window_start", F.col("column").alias("column_name"), "n_cur", F.round("psi", 9).alias("psi"))
