"""Training, anomaly detection and streams, in small."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskloom.operators import isolation, learn, matrix
from riskloom.params import MODELS, ScoringParams
from riskloom.plans import fixtures as fx
from riskloom.plans import job_queries, queries
from riskloom.session import work_dir
from riskloom.streaming import scoring as stream


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    featured = fx.featured_profile(spark, sf_dir)
    return matrix.assemble(matrix.feature_matrix(featured, ["c_custkey", "is_default"])).cache()


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "is_default int")
    positive = {r["is_default"]: r["weight"] for r in learn.with_class_weight(df, mode="positive").collect()}
    balanced = {r["is_default"]: r["weight"] for r in learn.with_class_weight(df, mode="balanced").collect()}
    assert positive == {1: 3.0, 0: 1.0} and balanced == {1: 2.0, 0: pytest.approx(2 / 3)}
    alone = learn.with_class_weight(df.filter("is_default = 0"), mode="positive")
    assert {r["weight"] for r in alone.collect()} == {1.0}
    with pytest.raises(ValueError):
        learn.with_class_weight(df, mode="other")


def test_draw_is_seeded_and_distinct():
    grid = learn.GRIDS["catboost"]
    first, second = learn.draw(grid, 20), learn.draw(grid, 20)
    assert first == second and len({tuple(p.items()) for p in first}) == 20
    assert len(learn.draw({"a": [1, 2]}, 20)) == 2
    assert learn.draw(grid, 20, seed=1) != first


def test_fit_save_load(spark, rows):
    slots = {"random_forest": learn.SLOTS["random_forest"]}
    fitted = learn.fit_all(rows, slots, overrides={"random_forest": {"numTrees": 5, "maxDepth": 4}})
    folder = work_dir(spark, "test-models")
    learn.save_models(fitted, folder)
    loaded = learn.load_models(folder)
    assert list(loaded) == ["random_forest"]
    scored = learn.score_all(learn.score(rows, fitted["random_forest"], "before"), loaded)
    assert scored.filter("before <> random_forest").isEmpty()
    assert learn.importances(loaded["random_forest"]).count() == 36
    with pytest.raises(ValueError):
        learn.load_models(work_dir(spark, "nothing"))


def test_isolation_forest_finds_planted_outliers(spark):
    inner = spark.range(600).select(
        "id", F.lit(0).alias("y"), F.rand(1).alias("a"), F.rand(2).alias("b"), F.lit(1.0).alias("flat")
    )
    far = spark.range(600, 605).select("id", F.lit(1).alias("y"), F.lit(9.0).alias("a"), F.lit(-9.0).alias("b"), F.lit(1.0).alias("flat"))
    data = inner.unionByName(far)
    forest = isolation.fit(data, ["a", "b", "flat"], "id", "y", trees=40, sample=64)
    per_tree = forest.nodes.groupBy("tree").agg(F.count("*").alias("n"), F.max("feature").alias("f"))
    assert per_tree.count() == 40 and per_tree.filter("n > 127 or f > 1").isEmpty()
    scored = isolation.score(data, forest)
    median = scored.agg(F.median("raw_score")).first()[0]
    assert scored.filter((F.col("y") == 1) & (F.col("raw_score") >= median)).isEmpty()
    folder = work_dir(spark, "forest")
    forest.save(folder)
    again = isolation.score(data, isolation.IsolationForest.load(spark, folder, ["a", "b", "flat"]))
    assert again.select("id", "raw_score").exceptAll(scored.select("id", "raw_score")).isEmpty()


def test_isolation_sample_sizes(spark):
    df = spark.range(1000).select("id", F.col("id").cast("double").alias("x"))
    drawn = isolation.draw_samples(df, "id", ["x"], 5, 16, 3, 1000)
    assert {r["count"] for r in drawn.groupBy("tree").count().collect()} == {16}
    few = isolation.draw_samples(df.limit(10), "id", ["x"], 5, 16, 3, 10)
    assert {r["count"] for r in few.groupBy("tree").count().collect()} == {10}


def test_isolation_trees_draw_from_all_rows(spark):
    """More rows than any pool of the trees' samples: what is drawn lies all over the table."""
    df = spark.range(40_000).select("id", F.col("id").cast("double").alias("x"))
    drawn = isolation.draw_samples(df, "id", ["x"], 100, 256, 3, 40_000)
    found = drawn.agg(F.count("*").alias("n"), F.countDistinct("_key").alias("keys")).first()
    assert found["n"] == 25_600 and found["keys"] > 64 * 256


def test_isolation_with_few_rows(spark):
    df = spark.range(60).select("id", F.sin("id").alias("x"), F.lit(0).alias("y"))
    forest = isolation.fit(df, ["x"], "id", "y", trees=50)
    assert forest.sample == 60
    scores = [r["raw_score"] for r in isolation.score(df, forest).collect()]
    assert max(scores) > 0 > min(scores)
    with pytest.raises(ValueError):
        isolation.fit(df.limit(0), ["x"], "id", "y")


def test_totals_of_many_micro_batches(spark):
    folder = work_dir(spark, "many")
    spark.range(240).select(F.col("id").cast("string")).repartition(120).write.text(folder)
    observed = stream.file_source(spark, folder, 1).withColumn("risk_score", F.lit(0.5))
    writer = stream.observed(observed).writeStream.format("noop")
    assert stream.run_and_count(spark, writer, work_dir(spark, "many-state")) == 240


def test_ids_that_are_no_numbers(spark, sf_dir):
    sent = fx.transaction_json(spark, sf_dir).filter("id % 50 > 4").limit(40)
    renamed = sent.select(F.regexp_replace("value", '("(?:ID|transaction_id)": *)"', '$1"tx_00').alias("value"))
    scored = queries.score_messages(renamed).collect()
    assert all(r["transaction_id"].startswith("tx_00") for r in scored)
    assert queries.score_messages(sent).count() == len(scored)
    folder = work_dir(spark, "named-ids")
    renamed.write.text(folder)
    predicted = stream.scored_stream(stream.file_source(spark, folder), job_queries.scorecards, MODELS, ScoringParams())
    assert stream.run_and_count(spark, stream.observed(predicted).writeStream.format("noop"), work_dir(spark, "named-state")) == 40


def test_features_and_labels_join_by_key(spark, sf_dir):
    from riskloom.sources import tables

    path = work_dir(spark, "split-tables")
    data = queries._split(spark, sf_dir)
    tables.write_split(data, "is_default", path)
    joined = spark.read.parquet(f"{path}/features").join(spark.read.parquet(f"{path}/labels").drop("split"), "c_custkey")
    assert joined.select(data.columns).exceptAll(data).isEmpty() and joined.count() == data.count()


def test_stream_equals_batch(spark, sf_dir):
    batch = queries._flat_alerts(queries.scoring_job(spark, sf_dir))
    streamed = job_queries._scoring_stream(spark, sf_dir)
    assert batch.count() > 0
    assert batch.exceptAll(streamed).isEmpty() and streamed.exceptAll(batch).isEmpty()


def test_restart_repeats_nothing(spark, sf_dir):
    batch = queries._flat_alerts(queries.scoring_job(spark, sf_dir))
    restarted = job_queries._restarted(spark, sf_dir)
    assert restarted.exceptAll(batch).isEmpty() and batch.exceptAll(restarted).isEmpty()


def test_alert_ids_are_stable(spark, sf_dir):
    first, second = (fx.alerts(spark, sf_dir).select("transaction_id", "alert_id") for _ in range(2))
    assert first.exceptAll(second).isEmpty()
    assert first.filter(~F.col("alert_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).isEmpty()


def test_reject_branch_keeps_messages(spark, sf_dir):
    source = stream.file_source(spark, job_queries._message_files(spark, sf_dir))
    alerts, rejects = work_dir(spark, "t-alerts"), work_dir(spark, "t-rejects")
    writer = stream.split_batches(source, job_queries.scorecards, MODELS, ScoringParams(), alerts, rejects)
    stream.run_all(writer, work_dir(spark, "t-state"))
    sent = fx.transaction_json(spark, sf_dir).filter("id % 50 < 5").select("value")
    kept = spark.read.schema("message string").json(f"{rejects}/batch=*").select("message")
    assert sent.exceptAll(kept).isEmpty() and kept.exceptAll(sent).isEmpty()


def test_flagship_plan_shuffles_only_for_the_profile(spark, sf_dir):
    """Scoring adds no shuffle, sort or Python to what building the transactions needs."""
    plan = fx.alerts(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    base = fx.credit_profile(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for node in ("Exchange", "Sort", "Window"):
        assert plan.count(node) == base.count(node)
    assert "Python" not in plan


def test_search_returns_every_trial(spark, rows):
    grid = {"numTrees": [3, 4], "maxDepth": [3]}
    _, best, trials = learn.search(rows, "random_forest", 2, 2, grid=grid)
    assert trials.count() == 2 and best in learn.draw(grid, 2)
    assert learn.best_trials(trials).count() == 1


def test_draw_makes_only_rows_that_trees_take(spark):
    """Rows made are fewer than twice those kept, every tree takes a row as often as any other, and gaps follow the share."""
    df = spark.range(50_000).withColumn("_key", F.col("id"))
    trees, sample = 40, 256
    share = (sample + 8 * sample**0.5 + 16) / 50_000
    first, taken = isolation._takers("_key", trees, share, 9)
    made = df.select("_key", first.alias("first"), taken.alias("taken")).persist()
    assert made.filter((F.col("first") >= trees) != (F.size("taken") == 0)).isEmpty()
    assert made.filter(F.size("taken") > F.size(F.array_distinct("taken"))).isEmpty()
    rows = made.select("_key", F.explode("taken").alias("tree"))
    per_tree = {r["tree"]: r["count"] for r in rows.groupBy("tree").count().collect()}
    assert set(per_tree) == set(range(trees)) and sum(per_tree.values()) < 2 * trees * sample
    spread = (50_000 * share) ** 0.5
    assert all(abs(n - 50_000 * share) < 5 * spread for n in per_tree.values())
    again = rows.groupBy("_key").count().filter("count > 1").count()  # as many pairs of trees as chance makes
    assert abs(again - 50_000 * (trees * share) ** 2 / 2) < 0.5 * 50_000 * (trees * share) ** 2 / 2
    every, _ = isolation._takers("_key", trees, 1.0, 9)[1], None
    assert df.limit(20).filter(F.size(every) != trees).isEmpty()


def test_patience_keeps_the_best_round(spark):
    """Labels that are mostly noise: the loss turns soon, the model is cut there, and equals one of so many rounds."""
    data = spark.range(400).select(
        (F.col("id") % 5 == 0).alias("held"), (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).cast("int").alias("is_default"),
        F.rand(1).alias("a"), F.rand(2).alias("b"),
    )
    rows = learn.evenly_kept(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(data))
    slot = learn.Slot("boosted", "positive", {"maxIter": 60})
    found = learn.fit_patiently(rows, slot, "held", 3, maxDepth=4, stepSize=0.4)
    assert found.losses[found.best - 1] == min(found.losses)
    assert found.best + 3 <= found.fitted < 60 and found.model.getNumTrees == found.best
    plain = learn.fit_slot(rows.filter("not held"), slot, maxIter=found.best, maxDepth=4, stepSize=0.4)
    both = learn.score(learn.score(rows, found.model, "cut"), plain, "plain")
    assert both.filter(F.abs(F.col("cut") - F.col("plain")) > 1e-9).isEmpty()
    whole = learn.fit_patiently(rows, slot, "held", 50, maxIter=4, maxDepth=2)
    assert whole.fitted == 4 and whole.model.getNumTrees == whole.best <= 4


def test_few_rows_are_kept_in_few_partitions(spark):
    """A fit passes over its rows many times, with a task per partition and tree level."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning")
    before = [spark.conf.get(name) for name in names]
    spark.conf.set(names[0], "150")
    try:
        kept = learn.evenly_kept(spark.range(20_000).groupBy((F.col("id") % 5_000).alias("id")).agg(F.count("*").alias("n")))
        assert spark.conf.get(names[1]) == before[1]
        assert kept.agg(F.sum("n")).head()[0] == 20_000
        assert kept.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism < 150
        kept.unpersist()
    finally:
        spark.conf.set(names[0], before[0])


def test_jobs_read_the_split_profile_from_one_folder(spark, sf_dir):
    """Not from the tables behind it, which every pass over the rows would join again."""
    parts = job_queries._parts(spark, sf_dir)
    assert all("/split-profile-" in f for part in parts for f in part.inputFiles())
    assert sum(part.count() for part in parts) == fx.credit_profile(spark, sf_dir).count()
    assert parts[0].unionByName(parts[1]).exceptAll(fx.credit_profile(spark, sf_dir)).isEmpty()
