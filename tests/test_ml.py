import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace import datagen as dg
from millrace.ml import classify, images, linear


def regression(spark, n=200):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 2))
    y = 1 + x @ [2, -3] + rng.normal(size=n) / 10
    return x, y, spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, y double")


@pytest.mark.parametrize("ridge", [0.0, 0.001, 10.0])
def test_ridge_equals_the_normal_equation(spark, ridge):
    x, y, df = regression(spark)
    full = np.column_stack([np.ones(len(x)), x])
    want = np.linalg.inv(full.T @ full + ridge * np.eye(3)) @ full.T @ y
    fit = linear.fit(df, ["a", "b"], "y", (0.0, ridge))[ridge]
    assert np.allclose(fit.weights, want)
    got = linear.rmse_of({ridge: fit}, df, "y").first()
    assert abs(got.rmse - np.sqrt(np.mean((y - full @ want) ** 2))) < 1e-9


def test_plain_fit_agrees_with_the_library(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    _, _, df = regression(spark)
    model = LinearRegression(labelCol="y", solver="normal").fit(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df))
    assert np.allclose(linear.fit(df, ["a", "b"], "y")[0.0].weights, [model.intercept, *model.coefficients])


def test_five_rows_without_bias(spark):
    x = [[27, 1675, 521], [52, 2359, 591], [52, 2127, 512], [52, 996, 264], [29, 716, 214]]
    y = [950, 1300, 800, 1000, 1300]
    df = spark.createDataFrame([(*a, b) for a, b in zip(x, y)], "age int, rooms int, bedrooms int, y int")
    fit = linear.fit(df, ["age", "rooms", "bedrooms"], "y", bias=False)[0.0]
    m = np.array(x, dtype=float)
    assert fit.terms == ["age", "rooms", "bedrooms"]
    assert np.allclose(fit.weights, np.linalg.inv(m.T @ m) @ m.T @ np.array(y))
    got = [r.p for r in df.select("age", "rooms", fit.predict().alias("p")).orderBy("age", "rooms").collect()]
    assert np.allclose(sorted(got), sorted(m @ fit.weights))


def test_target_is_no_feature(spark):
    _, _, df = regression(spark)
    with pytest.raises(ValueError):
        linear.fit(df, ["a", "y"], "y")


def test_fits_per_group(spark):
    _, _, df = regression(spark)
    both = df.withColumn("seed", F.lit(1)).unionByName(df.filter("a > 0").withColumn("seed", F.lit(2)))
    fits = linear.fit_groups(both, "seed", ["a", "b"], "y")
    assert np.allclose(fits[1].weights, linear.fit(df, ["a", "b"], "y")[0.0].weights)
    got = linear.grouped_rmse(fits, both, "seed", "y").collect()
    assert abs(got[0]["std"] - np.std([r.rmse for r in got])) < 1e-12


def people(spark, n=300):
    rng = np.random.default_rng(1)
    rows = [(i, ["x", "y", "z"][int(rng.integers(3))], float(rng.normal())) for i in range(n)]
    return spark.createDataFrame([(i, c, v, int((c == "x") + v + rng.normal() / 3 > 0.5)) for i, c, v in rows], "id int, c string, v double, label int")


def test_logistic_regression_minimizes_the_stated_loss(spark):
    df = people(spark)
    c = 10.0
    model = classify.train(df, ["c"], ["v"], "label", c)
    vectors = model.transform(df).select(vector_to_array("features").alias("f"), "label").collect()
    x, y = np.array([r.f for r in vectors]), np.array([r.label for r in vectors])
    fitted = model.stages[-1]
    w, b = fitted.coefficients.toArray(), fitted.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    # At the optimum the gradient of C * sum(loss) + |w|^2 / 2 is zero.
    assert np.abs(c * x.T @ (p - y) + w).max() < 0.5
    assert abs((p - y).sum()) < 0.05


def test_scoring_and_saving(spark, tmp_path):
    from pyspark.ml import PipelineModel

    df = people(spark)
    train, val = classify.split_80_20(df, "id", 2)
    assert (train.count(), val.count()) == (240, 60)
    model = classify.train(train, ["c"], ["v"], "label")
    scored = classify.score(model, val, ["id", "label"])
    assert classify.accuracy(scored, "label").first()[0] > 0.8
    assert scored.filter("flag <> (probability >= 0.5)").count() == 0
    model.write().overwrite().save(str(tmp_path / "m"))
    again = classify.score(PipelineModel.load(str(tmp_path / "m")), val, ["id", "label"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, scored.collect()))
    assert classify.feature_names(model, ["c"], ["v"]) == ["c=x", "c=y", "c=z", "v"]


def test_fit_and_judge(spark):
    _, area = classify.fit_and_judge(people(spark), "id", ["c"], ["v"], "label")
    got = area.first()
    assert got.n_pos + got.n_neg == 60 and got.auc > 0.9


def test_json_scoring_prepares_like_training(spark):
    df = people(spark).withColumn("paperless", F.when(F.col("v") > 0, "Yes").otherwise("No"))
    ready = classify.yes_no(df, "paperless")
    model = classify.train(ready, ["c"], ["v", "paperless"], "label")
    records = df.select(F.to_json(F.struct("id", "c", "v", "paperless")).alias("r"))
    got = classify.score_json(model, records, "r", "id int, c string, v double, paperless string", ["id"], ("paperless",))
    want = classify.score(model, ready, ["id"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_unseen_value_has_no_feature(spark):
    df = people(spark)
    model = Pipeline(stages=classify.encoder(["c"], ["v"])).fit(df)
    new = spark.createDataFrame([("q", 2.0), ("x", 1.0)], "c string, v double")
    got = [r[0] for r in model.transform(new).select(vector_to_array("features")).collect()]
    assert got == [[0, 0, 0, 2.0], [1, 0, 0, 1.0]]


def test_elimination_and_grid(spark):
    train, val = classify.split_80_20(people(spark), "id", 42)
    got = {r.feature: r.accuracy for r in classify.eliminate(train, val, ["c"], ["v"], "label").collect()}
    assert set(got) == {"c", "v"} and got["v"] < 0.9
    assert classify.compare(train, val, ["c"], ["v"], "label", [0.1, 10.0]).count() == 2


def test_network_learns(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(size=4) + 2 * (i % 2)], i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, vec array<float>, y int")
    model, history = classify.train_network(df, "vec", "y", iterations=20)
    losses = [r.loss for r in history.orderBy("epoch").collect()]
    assert losses[-1] < losses[0]
    scored = classify.predict_network(model, df, "vec", ["id", "y"])
    assert scored.filter("(probability >= 0.5) = (y = 1)").count() > 180


def test_resize_by_brute_force(spark):
    h, w, c = 7, 5, 3
    image = np.arange(h * w * c, dtype="float64")
    df = spark.createDataFrame([(1, image.tolist())], "id int, p array<double>")
    got = df.select(images.nearest_resize(F.col("p"), F.lit(h), F.lit(w), c, (4, 9))).first()[0]
    grid = image.reshape(h, w, c)
    want = [grid[int((y + 0.5) * h / 4), int((x + 0.5) * w / 9)].tolist() for y in range(4) for x in range(9)]
    assert got == [v for px in want for v in px]
    assert df.select(images.rescale(F.array(F.lit(0.0), F.lit(255.0)))).first()[0] == [0.0, 1.0]


def test_augmentation_by_brute_force(spark):
    h, w = 4, 6
    image = np.arange(h * w, dtype="float64")
    df = spark.createDataFrame([(1, image.tolist())], "id int, p array<double>")
    run = lambda *a: np.array(df.select(images.augment(F.col("p"), h, w, 1, *a)).first()[0]).reshape(h, w)
    grid = image.reshape(h, w)
    assert (run(F.lit(True), F.lit(0), F.lit(0)) == grid[:, ::-1]).all()
    assert (run(F.lit(False), F.lit(1), F.lit(0)) == grid[:, [1, 2, 3, 4, 5, 5]]).all()
    assert (run(F.lit(False), F.lit(0), F.lit(-1)) == grid[[0, 0, 1, 2]]).all()
    assert (run(F.lit(False), F.lit(0), F.lit(0), F.lit(180.0)) == grid[::-1, ::-1]).all()


def test_network_forward_by_brute_force(spark):
    shape = (6, 6, 2)
    weights = images.random_weights(shape, 3)
    rng = np.random.default_rng(4)
    batch = rng.normal(size=(3, *shape))
    want = []
    for image in batch:
        conv = np.zeros((4, 4, images.FILTERS))
        for y in range(4):
            for x in range(4):
                conv[y, x] = np.tensordot(image[y : y + 3, x : x + 3], weights["conv"], 3) + weights["conv_bias"]
        conv = np.maximum(conv, 0)
        pool = np.array([[conv[2 * y : 2 * y + 2, 2 * x : 2 * x + 2].max(axis=(0, 1)) for x in range(2)] for y in range(2)])
        hidden = np.maximum(pool.ravel() @ weights["dense"] + weights["dense_bias"], 0)
        want.append(float(1 / (1 + np.exp(-(hidden @ weights["out"] + weights["out_bias"])[0]))))
    df = spark.createDataFrame([(i, b.ravel().tolist()) for i, b in enumerate(batch)], "id long, p array<double>")
    got = images.score_images(df, "id", "p", shape, weights, batch=2).orderBy("id").collect()
    assert np.allclose([r.probability for r in got], want)


def test_weights_from_file(tmp_path):
    weights = images.random_weights((6, 6, 1), 1)
    np.savez(tmp_path / "w.npz", **weights)
    assert (images.load_weights(str(tmp_path / "w.npz"))["conv"] == weights["conv"]).all()


AS_OF = "2024-06-01 00:00:00"


def test_random_rows_repeat(spark):
    specs = [dg.Spec("id", "int", identity=True), dg.Spec("t", "varchar(30)"), dg.Spec("n", "int"), dg.Spec("d", "datetime"),
             dg.Spec("c", "int", computed=True), dg.Spec("u", "uniqueidentifier"), dg.Spec("x", "xml")]
    one, two = dg.random_table(spark, specs, 500, 1, AS_OF), dg.random_table(spark, specs, 500, 1, AS_OF).repartition(7)
    assert one.columns == ["t", "n", "d", "u", "x"]
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    other = dg.random_table(spark, specs, 500, 2, AS_OF)
    assert one.select("u").intersect(other.select("u")).count() == 0
    assert one.filter("x is not null").count() == 0
    assert one.select(F.countDistinct("u")).first()[0] == 500


def test_long_and_short_texts_follow_one_rule(spark, monkeypatch):
    specs = [dg.Spec("t", "varchar(50)")]
    short = dg.random_table(spark, specs, 300, 4, AS_OF).collect()
    monkeypatch.setattr(dg, "UNROLLED_TEXT", 10)
    assert short == dg.random_table(spark, specs, 300, 4, AS_OF).collect()
    sizes = [len(r.t) for r in short]
    assert max(sizes) <= 50 and 38 < sum(sizes) / 300 < 42  # 64 of 80 picks give a character
    assert len({r.t for r in short}) == 300 and set("".join(r.t for r in short)) == set(dg.ALPHABET)


def test_random_schema(spark):
    for seed in range(5):
        specs = dg.random_specs(seed, dg.MANY_ROW_TYPES)
        assert 1 <= len(specs) <= dg.MOST_COLUMNS and specs == dg.random_specs(seed, dg.MANY_ROW_TYPES)
        n = dg.random_row_count(seed)
        assert 1 <= n <= dg.MOST_ROWS
        df = dg.fill_random(spark.range(n), "id", specs, seed, AS_OF)
        assert df.count() == n and df.columns == [s.name for s in specs]


def test_random_ranges(spark):
    many = [dg.Spec(f"c{i}", k) for i, k in enumerate(dg.MANY_ROW_TYPES)]
    at = {s.type: s.name for s in many}
    df = dg.fill_random(spark.range(3000), "id", many, 3, AS_OF)
    low, high = (df.agg(*[f(s.name).alias(s.name) for s in many if s.type != "BIT"]).first() for f in (F.min, F.max))
    assert 0 <= low[at["TINYINT"]] and 240 < high[at["TINYINT"]] <= 255
    assert 30000 < high[at["SMALLINT"]] <= 32767 and 990_000 < high[at["BIGINT"]] < 1_000_000
    assert float(high[at["DECIMAL(10,2)"]]) < 1000 and float(high[at["DECIMAL(8,3)"]]) < 10
    assert str(low[at["DATE"]]) >= "2000-01-01" and str(high[at["DATE"]]) <= "2009-12-28"
    assert str(high[at["DATETIME"]]) < "2001-01-01" and high[at["TIME"]] < "08:45:36.000"
    assert df.filter(F.length(at["CHAR(5)"]) != 5).count() == 0 and df.filter(F.length(at["VARCHAR(50)"]) != 36).count() == 0


def test_specs_from_a_schema(spark):
    specs = dg.specs_of(spark.createDataFrame([], "a string, b int, c timestamp_ntz, d boolean, e double"))
    got = dg.random_table(spark, specs, 50, 1, AS_OF)
    assert got.filter("b is null or c is null or d is null or e is null or a is null").count() == 0


def test_tally(spark):
    assert dg.tally(spark, 1000).agg(F.sum("n")).first()[0] == 500500


def test_nulls_are_refused(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, None, 4.0), (3.0, 1.0, 5.0), (4.0, 2.0, None)], "a double, b double, y double")
    with pytest.raises(ValueError, match="2 rows"):
        linear.fit(df, ["a", "b"], "y")
    with pytest.raises(ValueError, match="rows"):
        linear.fit_groups(df.withColumn("g", F.lit(1)), "g", ["a", "b"], "y")
    got = {(r.row, r.col): r.value for r in linear.gram(df, ["a", "b"], "y").collect()}
    assert got["bias", "bias"] == 2 and got["a", "b"] == 5 and got["b", "y"] == 11


def test_too_many_groups_are_refused(spark, monkeypatch):
    monkeypatch.setattr(linear, "MOST_FITS", 3)
    df = spark.range(20).select((F.col("id") % 5).alias("g"), F.col("id").cast("double").alias("a"), F.rand(1).alias("y"))
    with pytest.raises(ValueError, match="more than 3"):
        linear.fit_groups(df, "g", ["a"], "y")


def test_rank_quality_leaves_out_nulls(spark):
    from millrace.operators import metrics
    from millrace.operators.running import width_chunk
    rows = [(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0), (None, 1), (0.95, None), (None, None)]
    df = spark.createDataFrame(rows, "s double, y int")
    got = metrics.auc(df, "s", "y", width_chunk(F.col("s"), 0.1)).first()
    assert (got.auc, got.n_pos, got.n_neg) == (0.75, 2, 2)
    low = metrics.threshold_counts(df, "s", "y", 10).filter("t = 0").first()
    assert (low.tp, low.fp) == (2, 2)


def test_step_size_matters(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(size=3) + 2 * (i % 2)], i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, vec array<float>, y int")
    train, val = df.filter("id < 90"), df.filter("id >= 90")
    got = classify.compare_steps(train, val, "vec", "y", [0.02, 1.0], hidden=6, iterations=6).orderBy("step", "epoch").collect()
    assert [(r.step, r.epoch) for r in got] == [(s, e) for s in (0.02, 1.0) for e in range(1, 7)]
    slow, fast = [[r.loss for r in got if r.step == s] for s in (0.02, 1.0)]
    assert slow != fast and fast[-1] < slow[-1] < slow[0]
    for s in (0.02, 1.0):
        best = -1.0
        for r in [r for r in got if r.step == s]:
            assert r.saved == (r.val_accuracy > best) and 0 <= r.accuracy <= 1
            best = max(best, r.val_accuracy)
    model, history = classify.train_network(train, "vec", "y", hidden=6, step=1.0, iterations=6, validation=val)
    scored = classify.predict_network(model, val, "vec", ["y"])
    assert scored.agg(F.avg(((F.col("probability") > 0.5) == (F.col("y") == 1)).cast("int"))).first()[0] == max(r.val_accuracy for r in history.collect())


@pytest.mark.parametrize("batches, momentum", [(1, 0.0), (5, 0.8)])
def test_mini_batches_equal_a_plain_run(spark, batches, momentum):
    """The same training written plainly over all rows at once."""
    from millrace.ml import network
    rng = np.random.default_rng(8)
    rows = [(i, [float(v) for v in rng.normal(size=5) + (i % 2)], i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, vec array<double>, y int").repartition(7)
    train, val = df.filter("id < 240"), df.filter("id >= 240")
    net, history = network.train(train, "vec", "y", hidden=6, step=0.1, momentum=momentum, epochs=6, batches=batches, seed=3, validation=val)
    numbered = train.select(F.col("vec").alias("vector"), F.col("y").cast("double").alias("label")).withColumn("b", network.batch_number("vector", "label", batches, 3)).collect()
    x, y, b = np.array([r[0] for r in numbered]), np.array([r[1] for r in numbered]), np.array([r[2] for r in numbered])
    vx, vy = np.array([r[1] for r in rows[240:]]), np.array([r[2] for r in rows[240:]])
    first = network.first_network(5, 6, 3)
    w, order = [first.w1, first.b1, first.w2, np.array(first.b2)], np.random.default_rng(4)
    speed, want, chance = [0 * p for p in w], [], lambda a: 1 / (1 + np.exp(-(np.maximum(a @ w[0] + w[1], 0) @ w[2] + w[3])))
    for epoch in range(1, 7):
        loss = right = 0.0
        for k in order.permutation(batches):
            xs, ys = x[b == k], y[b == k]
            h, p = np.maximum(xs @ w[0] + w[1], 0), chance(xs)
            loss, right = loss - (ys * np.log(p) + (1 - ys) * np.log(1 - p)).sum(), right + ((p >= 0.5) == (ys == 1)).sum()
            e = (p - ys) / len(ys)
            d = e[:, None] * w[2] * (h > 0)
            for i, g in enumerate([xs.T @ d, d.sum(0), h.T @ e, e.sum()]):
                speed[i] = momentum * speed[i] - 0.1 * g
                w[i] = w[i] + speed[i]
        want.append((epoch, loss / len(y), right / len(y), ((chance(vx) >= 0.5) == (vy == 1)).mean()))
    got = [tuple(r)[:4] for r in history.orderBy("epoch").collect()]
    assert np.abs(np.array(got) - np.array(want)).max() < 1e-6
    scored = {r["id"]: r["probability"] for r in network.predict(net, val, "vec", ["id"]).collect()}
    assert len(scored) == 60 and ((np.array([scored[i] for i in range(240, 300)]) >= 0.5) == (vy == 1)).mean() == max(r[3] for r in got)


def test_mini_batches_refuse_nulls(spark):
    from millrace.ml import network
    for vec, y in (([1.0, None], 1), ([1.0], 1), (None, 1), ([1.0, float("nan")], 0), ([1.0, 2.0], None)):
        df = spark.createDataFrame([([1.0, 2.0], 1), (vec, y)], "vec array<double>, y int")
        with pytest.raises(ValueError, match="rows"):
            network.train(df, "vec", "y")
