"""Feature tables, regression, classification and image jobs."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from millrace.ml import classify, images, linear
from millrace.operators.rows import exact_split
from millrace.probes.registry import Tables, probe

_X = ["l_quantity", "l_discount"]
_COLS_SQL = "SELECT 1.0 AS x0, l_quantity AS x1, l_discount AS x2, ln(1 + l_extendedprice) AS y FROM lineitem"


def _prices(t: Tables):
    return t.lineitem.select("l_quantity", "l_discount", F.log1p("l_extendedprice").alias("y"))


@probe("gram_matrix", f"""
WITH d AS ({_COLS_SQL}), n AS (SELECT * FROM (VALUES (0, 'bias'), (1, 'l_quantity'), (2, 'l_discount')) v(i, name)),
s AS (SELECT i.name AS row, j.name AS col, sum(CASE i.i WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END * CASE j.i WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END) AS value
      FROM d, n i, n j GROUP BY 1, 2
      UNION ALL SELECT i.name, 'y', sum(CASE i.i WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END * y) FROM d, n i GROUP BY 1)
SELECT row, col, round(value, 4) AS value FROM s
""")
def gram_matrix(t: Tables):
    return linear.gram(_prices(t), _X, "y").select("row", "col", F.round("value", 4).alias("value"))


@probe("linreg_weights", f"""
WITH d AS ({_COLS_SQL}), c AS (SELECT covar_pop(x1, x1) a, covar_pop(x1, x2) b, covar_pop(x2, x2) c, covar_pop(x1, y) p, covar_pop(x2, y) q,
                                      avg(x1) m1, avg(x2) m2, avg(y) my FROM d),
w AS (SELECT (p * c - q * b) / (a * c - b * b) AS w1, (q * a - p * b) / (a * c - b * b) AS w2, m1, m2, my FROM c)
SELECT 'bias' AS feature, round(my - w1 * m1 - w2 * m2, 6) AS weight FROM w
UNION ALL SELECT 'l_quantity', round(w1, 6) FROM w UNION ALL SELECT 'l_discount', round(w2, 6) FROM w
""")
def linreg_weights(t: Tables):
    fit = linear.fit(_prices(t), _X, "y")[0.0]
    rows = [(f, round(w, 6)) for f, w in fit.named()]
    return t.spark.createDataFrame(rows, "feature string, weight double")


_ORDER_X = ["x1", "x2"]
# The ridge values that are compared.
_RIDGES = (0.0, 0.000001, 0.0001, 0.001, 0.01, 0.1, 1.0, 5.0, 10.0)


def _orders(t: Tables):
    """Order price by customer group and month; one price in seven is missing a feature."""
    x2 = F.when(F.col("o_orderkey") % 7 != 0, F.month("o_orderdate").cast("double"))
    return t.orders.select(
        "o_orderkey", (F.col("o_custkey") % 50).cast("double").alias("x1"), F.coalesce(x2, F.lit(0.0)).alias("x2"),
        F.log1p("o_totalprice").alias("y"),
    )


_ORDERS_SQL = """
o AS (SELECT o_orderkey, CAST(o_custkey % 50 AS DOUBLE) AS x1, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(month(o_orderdate) AS DOUBLE) ELSE 0 END AS x2,
             ln(1 + o_totalprice) AS y FROM orders),
seeds AS (SELECT CAST(range AS INTEGER) AS seed FROM range({seeds})),
h AS (SELECT o.*, seed, row_number() OVER (PARTITION BY seed ORDER BY md5(seed || '|' || o_orderkey), o_orderkey) AS rn,
             count(*) OVER (PARTITION BY seed) AS n FROM o, seeds),
p AS (SELECT *, CASE WHEN rn <= n - 2 * floor(n * 0.2) THEN 'train' WHEN rn <= n - floor(n * 0.2) THEN 'val' ELSE 'test' END AS split FROM h)
"""
# Weights of a 3x3 system by determinants, the ridge value added to the whole diagonal.
_SOLVE_SQL = """
s AS (SELECT {key}, r, count(*) + r AS a, sum(x1) AS b, sum(x2) AS c, sum(x1 * x1) + r AS d, sum(x1 * x2) AS e, sum(x2 * x2) + r AS f,
             sum(y) AS p, sum(x1 * y) AS q, sum(x2 * y) AS u FROM {fit}, rid GROUP BY {key}, r),
dt AS (SELECT *, a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c) AS det FROM s),
w AS (SELECT {key}, r, (p * (d * f - e * e) - b * (q * f - e * u) + c * (q * e - d * u)) / det AS w0,
             (a * (q * f - e * u) - p * (b * f - e * c) + c * (b * u - q * c)) / det AS w1,
             (a * (d * u - q * e) - b * (b * u - q * c) + p * (b * e - d * c)) / det AS w2 FROM dt)
"""
_PARTS = [("train", 0.6), ("val", 0.2), ("test", 0.2)]


@probe("ridge_grid", "WITH " + _ORDERS_SQL.format(seeds=43) + """,
t AS (SELECT * FROM p WHERE seed = 42 AND split = 'train'),
rid AS (SELECT unnest([0, 0.000001, 0.0001, 0.001, 0.01, 0.1, 1, 5, 10])::DOUBLE AS r),""" + _SOLVE_SQL.format(key="seed", fit="t") + """
SELECT r AS ridge, round(sqrt(avg(power(y - (w0 + w1 * x1 + w2 * x2), 2))), 6) AS rmse
FROM p JOIN w ON p.seed = w.seed WHERE split = 'val' GROUP BY 1
""")
def ridge_grid(t: Tables):
    parts = exact_split(_orders(t), "o_orderkey", 42, _PARTS)
    fits = linear.fit(parts.filter("split = 'train'"), _ORDER_X, "y", _RIDGES)
    out = linear.rmse_of(fits, parts.filter("split = 'val'"), "y")
    return out.select("ridge", F.round("rmse", 6).alias("rmse"))


@probe("seed_stability", "WITH " + _ORDERS_SQL.format(seeds=10) + """,
t AS (SELECT * FROM p WHERE split = 'train'), rid AS (SELECT 0.0::DOUBLE AS r),""" + _SOLVE_SQL.format(key="seed", fit="t") + """,
e AS (SELECT p.seed, sqrt(avg(power(y - (w0 + w1 * x1 + w2 * x2), 2))) AS rmse FROM p JOIN w ON p.seed = w.seed WHERE split = 'val' GROUP BY 1)
SELECT seed, round(rmse, 6) AS rmse, (SELECT round(stddev_pop(rmse), 6) FROM e) AS std FROM e
""")
def seed_stability(t: Tables):
    parts = exact_split(_orders(t), "o_orderkey", list(range(10)), _PARTS)
    fits = linear.fit_groups(parts.filter("split = 'train'"), "seed", _ORDER_X, "y")
    out = linear.grouped_rmse(fits, parts.filter("split = 'val'"), "seed", "y")
    return out.select("seed", F.round("rmse", 6).alias("rmse"), F.round("std", 6).alias("std"))


@probe("final_fit_rmse", "WITH " + _ORDERS_SQL.format(seeds=10) + """,
t AS (SELECT * FROM p WHERE seed = 9 AND split <> 'test'), rid AS (SELECT 0.001::DOUBLE AS r),""" + _SOLVE_SQL.format(key="seed", fit="t") + """
SELECT round(sqrt(avg(power(y - (w0 + w1 * x1 + w2 * x2), 2))), 6) AS rmse FROM p JOIN w ON p.seed = w.seed WHERE split = 'test'
""")
def final_fit_rmse(t: Tables):
    parts = exact_split(_orders(t), "o_orderkey", 9, _PARTS)
    fits = linear.fit(parts.filter("split <> 'test'"), _ORDER_X, "y", (0.001,))
    return linear.rmse_of(fits, parts.filter("split = 'test'"), "y").select(F.round("rmse", 6).alias("rmse"))


_CATS, _NUMS = ["lang", "source"], ["log_chars"]


def _churn(t: Tables):
    docs = t.documents.select("doc_id", "lang", "source", F.log1p("n_chars").alias("log_chars"))
    return t.labels.join(docs, "doc_id").select("doc_id", *_CATS, *_NUMS, F.col("quality").alias("label"))


@probe("one_hot", """
SELECT doc_id, 'lang=' || lang AS feature, 1.0::DOUBLE AS value FROM documents UNION ALL SELECT doc_id, 'source=' || source, 1.0 FROM documents
UNION ALL SELECT doc_id, 'n_chars', CAST(n_chars AS DOUBLE) FROM documents
""")
def one_hot(t: Tables):
    return classify.one_hot_long(t.documents, "doc_id", ["lang", "source"], ["n_chars"])


@probe("one_hot_vectors", """
WITH v AS (SELECT (SELECT count(DISTINCT lang) + count(DISTINCT source) FROM documents WHERE lang <> 'es') AS size)
SELECT doc_id, size + 1 AS size, CASE WHEN lang = 'es' THEN 1 ELSE 2 END::DOUBLE AS ones FROM documents, v
""")
def one_hot_vectors(t: Tables):
    """Encoder fitted without one language: its rows get no language feature at all."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    docs = t.documents.select("doc_id", "lang", "source", F.lit(0.0).alias("zero"))
    model = Pipeline(stages=classify.encoder(_CATS, ["zero"])).fit(docs.filter("lang <> 'es'"))
    vec = vector_to_array("features")
    return model.transform(docs).select(
        "doc_id", F.size(vec).cast("long").alias("size"), F.aggregate(vec, F.lit(0.0), lambda a, v: a + v).alias("ones")
    )


@probe("logreg_scores")
def logreg_scores(t: Tables):
    train, val = classify.split_80_20(_churn(t), "doc_id", 2)
    model = classify.train(train, _CATS, _NUMS, "label", 10.0)
    return classify.score(model, val, ["doc_id", "label"]).select("doc_id", "label", F.round("probability", 4).alias("probability"), "flag")


@probe("logreg_optimum", """
WITH d AS (SELECT l.doc_id, lang, source, n_chars, row_number() OVER (ORDER BY md5('2|' || l.doc_id), l.doc_id) AS rn, count(*) OVER () AS n
           FROM labels l JOIN documents USING (doc_id)), t AS (SELECT * FROM d WHERE rn <= n - floor(n * 0.2))
SELECT 'lang=' || lang AS feature, count(*) AS n_rows, true AS flat FROM t GROUP BY 1
UNION ALL SELECT 'source=' || source, count(*), true FROM t GROUP BY 1
UNION ALL SELECT 'log_chars', count(*) FILTER (WHERE n_chars > 0), true FROM t UNION ALL SELECT 'bias', count(*), true FROM t
""")
def logreg_optimum(t: Tables):
    """The fitted weights are the optimum: the loss has no slope along any feature."""
    train, _ = classify.split_80_20(_churn(t), "doc_id", 2)
    model = classify.train(train, _CATS, _NUMS, "label", 10.0)
    slopes = classify.loss_slopes(model, train, _CATS, _NUMS, "label", 10.0)
    return slopes.select("feature", "n_rows", (F.abs("slope") < 1e-4).alias("flat"))


@probe("churn_auc")
def churn_auc(t: Tables):
    _, area = classify.fit_and_judge(_churn(t), "doc_id", _CATS, _NUMS, "label")
    return area.select(F.round("auc", 3).alias("auc"), "n_pos", "n_neg")


@probe("model_roundtrip", "SELECT count(*) AS n, true AS same FROM documents")
def model_roundtrip(t: Tables):
    """A saved and loaded model scores every document as before."""
    model = classify.train(_churn(t), _CATS, _NUMS, "label", 10.0)
    path = t.scratch("model")
    model.write().overwrite().save(path)
    docs = t.documents.select("doc_id", "lang", "source", F.log1p("n_chars").alias("log_chars"))
    old = classify.score(model, docs, ["doc_id"])
    new = classify.score(PipelineModel.load(path), docs, ["doc_id"]).select("doc_id", F.col("probability").alias("again"))
    return old.join(new, "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("probability") == F.col("again")).alias("same")
    )


@probe("batch_scoring")
def batch_scoring(t: Tables):
    """JSON records scored with the preparation used in training; text numbers are read as numbers."""
    model = classify.train(_churn(t), _CATS, _NUMS, "label", 10.0)
    records = t.documents.select(F.to_json(F.struct(
        "doc_id", "lang", "source", F.log1p("n_chars").alias("log_chars"))).alias("record"))
    out = classify.score_json(model, records, "record", "doc_id long, lang string, source string, log_chars double", ["doc_id"])
    return out.select("doc_id", F.round("probability", 4).alias("probability"), F.col("flag").alias("churn"))


@probe("feature_elimination")
def feature_elimination(t: Tables):
    train, val = classify.split_80_20(_churn(t), "doc_id", 42)
    return classify.eliminate(train, val, _CATS, _NUMS, "label").withColumn("accuracy", F.round("accuracy", 3))


@probe("param_grid")
def param_grid(t: Tables):
    train, val = classify.split_80_20(_churn(t), "doc_id", 42)
    return classify.compare(train, val, _CATS, _NUMS, "label", [0.01, 0.1, 1.0, 10.0])


def _vectors(t: Tables):
    return t.embeddings.select("vec_id", "embedding", (F.col("label") >= 5).cast("int").alias("y"))


@probe("mlp_train")
def mlp_train(t: Tables):
    """Loss and accuracy per epoch of a network with 64 hidden units, trained in mini-batches, with the best-so-far flag."""
    train, val = classify.split_80_20(_vectors(t), "vec_id", 42)
    _, history = classify.train_network(train, "embedding", "y", step=0.02, iterations=5, validation=val, momentum=0.8, batches=4)
    return history.withColumns({c: F.round(c, 4) for c in ("loss", "accuracy", "val_accuracy")})


@probe("nearest_resize", """
WITH g AS (SELECT vec_id, embedding, unnest(range(25)) AS pos FROM embeddings)
SELECT vec_id, CAST(pos AS INTEGER) AS pos,
       CAST(embedding[((pos // 5 * 2 + 1) * 8 // 10) * 8 + ((pos % 5 * 2 + 1) * 8 // 10) + 1] AS DOUBLE) / 255 AS value FROM g
""")
def nearest_resize(t: Tables):
    """Vectors read as 8 x 8 grey images, resized to 5 x 5 and divided by 255."""
    small = images.nearest_resize(F.col("embedding"), F.lit(8), F.lit(8), 1, (5, 5))
    return t.embeddings.select("vec_id", F.posexplode(images.rescale(small)).alias("pos", "value"))


@probe("image_flip_shift", """
WITH g AS (SELECT vec_id, embedding, vec_id % 2 = 0 AS flip, vec_id % 3 - 1 AS dx, vec_id % 5 - 2 AS dy, unnest(range(64)) AS pos FROM embeddings),
s AS (SELECT vec_id, pos, embedding, least(greatest(pos // 8 + dy, 0), 7) AS y,
             least(greatest(CASE WHEN flip THEN 7 - pos % 8 ELSE pos % 8 END + dx, 0), 7) AS x FROM g)
SELECT vec_id, CAST(pos AS INTEGER) AS pos, CAST(embedding[y * 8 + x + 1] AS DOUBLE) AS value FROM s
""")
def image_flip_shift(t: Tables):
    new = images.augment(
        F.col("embedding"), 8, 8, 1, F.col("vec_id") % 2 == 0, F.col("vec_id") % 3 - 1, F.col("vec_id") % 5 - 2
    )
    return t.embeddings.select("vec_id", F.posexplode(new).alias("pos", "value")).withColumn("value", F.col("value").cast("double"))


@probe("image_augmentation", "SELECT vec_id, 64 AS n, true AS known_pixels FROM embeddings")
def image_augmentation(t: Tables):
    """Seeded rotation, shift, zoom and flip: every output pixel comes from the same image."""
    changed = images.seeded_augment(t.embeddings.withColumn("old", F.col("embedding")), "vec_id", "embedding", 8, 8, 1, 42)
    known = F.size(F.array_except("embedding", "old")) == 0
    return changed.select("vec_id", F.size("embedding").alias("n"), known.alias("known_pixels"))


_WEIGHT, _BIAS = "(({} * 37) % 101 - 50) / {}", "(({} * 13) % 7 - 3) / 10.0"


@probe("cnn_batch_scoring", f"""
WITH pixel AS (SELECT vec_id, p // 8 AS y, p % 8 AS x, CAST(embedding[p + 1] AS DOUBLE) AS v FROM (SELECT vec_id, embedding, unnest(range(64)) AS p FROM embeddings)),
kernel AS (SELECT k // 96 AS i, k // 32 % 3 AS j, k % 32 AS f, {_WEIGHT.format("k", "250.0")} AS w FROM range(288) r(k)),
conv AS (SELECT vec_id, y - i AS cy, x - j AS cx, f, sum(v * w) AS s FROM pixel, kernel WHERE y - i BETWEEN 0 AND 5 AND x - j BETWEEN 0 AND 5 GROUP BY ALL),
pool AS (SELECT vec_id, cy // 2 AS py, cx // 2 AS px, f, max(greatest(s + {_BIAS.format("f")}, 0)) AS v FROM conv GROUP BY ALL),
dense AS (SELECT vec_id, u, greatest(sum(v * {_WEIGHT.format("(((py * 3 + px) * 32 + f) * 64 + u)", "1000.0")}) + {_BIAS.format("u")}, 0) AS v
          FROM pool, range(64) r(u) GROUP BY vec_id, u)
SELECT vec_id, round(1 / (1 + exp(-(sum(v * {_WEIGHT.format("u", "250.0")}) + {_BIAS.format("0")}))), 6) AS probability FROM dense GROUP BY 1
""")
def cnn_batch_scoring(t: Tables):
    """The whole network of the survey, its weights by rule, against convolution, pooling and layers as joins and sums."""
    shape = (8, 8, 1)
    scored = images.score_images(t.embeddings, "vec_id", "embedding", shape, images.stated_weights(shape))
    return scored.select("vec_id", F.round("probability", 6).alias("probability"))


@probe("step_comparison")
def step_comparison(t: Tables):
    """Histories of two learning rates under each other."""
    train, val = classify.split_80_20(_vectors(t), "vec_id", 42)
    got = classify.compare_steps(train, val, "embedding", "y", [0.002, 0.2], hidden=16, iterations=2, momentum=0.8, batches=2)
    return got.withColumns({c: F.round(c, 4) for c in ("loss", "accuracy", "val_accuracy")})
