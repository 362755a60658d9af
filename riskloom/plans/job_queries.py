"""Catalogue entries that run jobs: training, search and streams.

The learners run with the rounds of ``QUICK`` here so that the catalogue stays quick, except in
``j13_training_job``, which fits every slot and the isolation forest at their own sizes. What is
returned are facts that hold whichever way a learner breaks ties.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import features
from riskloom.functions.features import FEATURE_NAMES
from riskloom.operators import evaluation, isolation, learn, matrix, metrics, ranking, report, splits
from riskloom.params import HISTORY_CAPS, MODELS, ScoringParams
from riskloom.plans import fixtures as fx
from riskloom.plans import training
from riskloom.plans.scoring import score_transactions
from riskloom.plans.queries import Query, _flat_alerts, _saved, tidy
from riskloom.session import discard, work_dir
from riskloom.sources import replay, tables, wire
from riskloom.sources.tables import table
from riskloom.streaming import quality
from riskloom.streaming import scoring as stream
from riskloom.streaming.history import read_history, recent_history_stream
from riskloom.streaming.velocity import velocity_stream

KEY, LABEL = "c_custkey", "is_default"
PARAMS = ScoringParams()
QUICK = {
    **{n: {"maxIter": 5, "maxDepth": 4} for n in ("xgboost", "catboost", "lightgbm")},
    "random_forest": {"numTrees": 10, "maxDepth": 5},
}


def _parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, kept: splits, scaling and folds each read them again, and the joins behind them are dear."""
    profile, kept = work_dir(spark, "profile"), work_dir(spark, "split-profile")
    fx.credit_profile(spark, sf).write.parquet(profile)
    splits.stratified_split(spark.read.parquet(profile), KEY, LABEL).write.parquet(kept)
    discard(spark, profile)
    split = spark.read.parquet(kept)
    return split.filter(F.col("split") == "train").drop("split"), split.filter(F.col("split") == "test").drop("split")


def _assembled(spark: SparkSession, sf: str) -> DataFrame:
    featured = fx.featured_profile(spark, sf)
    return matrix.assemble(matrix.feature_matrix(featured, [KEY, LABEL]))


def _auc_row(scored: DataFrame, name: str) -> DataFrame:
    """Rows scored, how many scores are probabilities, and whether in-sample AUC shows that it learned."""
    long = learn.long_scores(scored, [name], KEY, LABEL)
    inside = long.groupBy("model").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("score").between(0.0, 1.0)).alias("n_valid")
    )
    joined = evaluation.roc_auc(long).join(inside, "model")
    return joined.select("model", "n_rows", "n_valid", (F.col("roc_auc") > 0.7).alias("learned"))


def _fit_and_score(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = _assembled(spark, sf)
        models = learn.fit_all(rows, {name: learn.SLOTS[name]}, LABEL, None, QUICK)
        return _auc_row(learn.score_all(rows, models), name)

    return run


def _batch_scores(spark: SparkSession, sf: str) -> DataFrame:
    rows = _assembled(spark, sf)
    models = learn.fit_all(rows, {n: learn.SLOTS[n] for n in ("xgboost", "random_forest")}, LABEL, None, QUICK)
    scored = learn.score_all(rows, models)
    return scored.agg(F.count("*").alias("n"), *[F.count_if(F.col(m).between(0, 1)).alias(f"n_{m}") for m in models])


def _early_stopping(spark: SparkSession, sf: str) -> DataFrame:
    """Whether boosting stops before its rounds are up when the labels are noise."""
    train, _ = training.prepare(*_parts(spark, sf), KEY, LABEL)
    noise = train.withColumn(LABEL, (F.pmod(F.xxhash64(F.lit(3), KEY), F.lit(2)) == 0).cast("int"))
    rounds = {"lightgbm": {"maxIter": 40, "maxDepth": 3}}
    model = learn.fit_all(noise, {"lightgbm": learn.SLOTS["lightgbm"]}, LABEL, "is_validation", rounds)["lightgbm"]
    kept = model.getNumTrees
    return noise.agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(40).alias("rounds_asked"), F.lit(kept < 40).alias("stopped_early"))


def _staged_stopping(spark: SparkSession, sf: str) -> DataFrame:
    """Boosting with patience on the real labels: where it was best, where it ended, and what it was asked for."""
    train, _ = training.prepare(*_parts(spark, sf), KEY, LABEL)
    rows = learn.evenly_kept(train)
    found = learn.fit_patiently(rows, learn.SLOTS["lightgbm"], "is_validation", 5, LABEL, maxIter=200, maxDepth=6, stepSize=0.3)
    held_out = rows.filter("is_validation")
    scored = learn.score(held_out, found.model, "p").select(F.when(F.col(LABEL) == 1, F.col("p")).otherwise(1.0 - F.col("p")).alias("right"))
    # Spark's loss is twice the negative log-likelihood.
    loss = scored.agg(F.count("*").alias("n_rows"), F.avg(-2.0 * F.ln("right")).alias("loss"))
    return loss.select(
        "n_rows",
        F.lit(200).alias("rounds_asked"),
        F.lit(found.best < found.fitted).alias("best_before_last"),
        F.lit(found.fitted < 200).alias("ended_early"),
        (F.abs(F.col("loss") - min(found.losses)) < 1e-6).alias("cut_equals_stage"),
    )


def _isolation(spark: SparkSession, sf: str) -> DataFrame:
    featured = matrix.feature_matrix(fx.featured_profile(spark, sf), [KEY, LABEL])
    forest = isolation.fit(featured, FEATURE_NAMES, KEY, LABEL)
    scored = metrics.anomaly_probability(isolation.score(featured, forest).checkpoint(), "raw_score")
    # Rows that pay far later than most lie apart from the rest.
    apart = F.avg(F.when(F.col("months_delayed") >= 4, F.col("anomaly_score")))
    return scored.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("anomaly_score").between(0, 1)).alias("n_valid"),
        F.min("anomaly_score").alias("lowest"),
        F.max("anomaly_score").alias("highest"),
        (apart > F.avg("anomaly_score")).alias("late_payers_stand_out"),
    )


_SMALL_GRIDS = {
    "xgboost": {"maxIter": [3, 5], "maxDepth": [3, 4]},
    "random_forest": {"numTrees": [5, 10], "maxDepth": [4]},
}


def _search(spark: SparkSession, sf: str) -> DataFrame:
    rows = _assembled(spark, sf)
    _, _, trials = learn.search(rows, "random_forest", 2, 3, KEY, LABEL, _SMALL_GRIDS["random_forest"])
    valid = F.col("cv_f1").between(0, 1)
    return trials.select("model", "trial", F.size("params").alias("n_params"), valid.alias("valid"))


def _penalised_search(spark: SparkSession, sf: str) -> DataFrame:
    """Trials over leaf penalties, and whether the best model keeps leaf values of its own for each tree."""
    grid = {"maxIter": [3], "maxDepth": [3], "l2_leaf_reg": [1, 7]}
    best, _, trials = learn.search(_assembled(spark, sf), "catboost", 2, 2, KEY, LABEL, grid)
    refitted = len(best.values) == best.getNumTrees
    valid = F.col("cv_f1").between(0, 1)
    return trials.select("model", F.col("params")["l2_leaf_reg"].alias("l2_leaf_reg"), valid.alias("valid"), F.lit(refitted).alias("refitted"))


def _best_trials(spark: SparkSession, sf: str) -> DataFrame:
    """Per model the number of trials, and whether the best one has the highest score of all."""
    rows = _assembled(spark, sf)
    _, _, trials = learn.search(rows, "xgboost", 2, 2, KEY, LABEL, _SMALL_GRIDS["xgboost"])
    counted = trials.groupBy("model").agg(F.count("*").alias("n_trials"), F.max("cv_f1").alias("highest"))
    joined = learn.best_trials(trials).join(counted, "model")
    return joined.select("model", "n_trials", (F.col("cv_f1") == F.col("highest")).alias("is_highest"))


def _validation_auc(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = training.prepare(*_parts(spark, sf), KEY, LABEL)
    models = learn.fit_all(train, learn.SLOTS, LABEL, "is_validation", QUICK)
    held_out = learn.score_all(train.filter("is_validation"), models).select(KEY, LABEL, *models).checkpoint()
    areas = learn.validation_auc(held_out, list(models), KEY, LABEL)
    counted = areas.crossJoin(F.broadcast(held_out.agg(F.count("*").alias("n_rows"))))  # one row
    return counted.select("model", "n_rows", F.col("val_roc_auc").between(0.0, 1.0).alias("valid"))


def _forest(spark: SparkSession, sf: str) -> Model:
    slots = {"random_forest": learn.SLOTS["random_forest"]}
    return learn.fit_all(_assembled(spark, sf), slots, LABEL, None, QUICK)["random_forest"]


def _importance_facts(listed: DataFrame) -> DataFrame:
    return listed.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("feature").isin(*FEATURE_NAMES)).alias("n_known"),
        F.count_if(F.col("importance") >= 0).alias("n_not_negative"),
        F.round(F.sum("importance"), 6).alias("total"),
    )


def _importances(spark: SparkSession, sf: str) -> DataFrame:
    model = learn.importances(_forest(spark, sf))
    named = lambda df, name: _importance_facts(df).withColumn("model", F.lit(name))
    return named(model, "random_forest").unionByName(named(learn.uniform_importances(spark), "uniform"))


def _top_importances(spark: SparkSession, sf: str) -> DataFrame:
    """Facts about the twenty highest: how many, that none left out is higher, that they are shares."""
    every = learn.importances(_forest(spark, sf))
    top = ranking.top_importances(every, 20)
    rest = every.join(top.select("feature"), "feature", "left_anti")
    lowest = top.agg(F.count("*").alias("n"), F.min("importance").alias("low"), F.sum("importance").alias("total"))
    both = lowest.crossJoin(F.broadcast(rest.agg(F.max("importance").alias("left_out"), F.count("*").alias("n_left"))))  # one row each
    return both.select(
        "n", "n_left", (F.col("left_out") <= F.col("low")).alias("none_higher"), (F.col("total") <= 1.000001).alias("are_shares")
    )


def _save_load(spark: SparkSession, sf: str) -> DataFrame:
    rows = _assembled(spark, sf)
    folder = work_dir(spark, "models")
    fitted = learn.fit_all(rows, {n: learn.SLOTS[n] for n in ("catboost", "random_forest")}, LABEL, None, QUICK)
    learn.save_models(fitted, folder)
    loaded = learn.load_models(folder)
    scored = learn.score_all(rows, {f"{n}_saved": m for n, m in fitted.items()})
    scored = learn.score_all(scored, loaded)
    same = [F.count_if(F.col(n) == F.col(f"{n}_saved")).alias(f"same_{n}") for n in loaded]
    return scored.agg(F.count("*").alias("n"), *same)


def _ranked(comparison: DataFrame) -> DataFrame:
    """Which models were compared, that their ranks run from 1, and that a better rank has no lower AUC."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "roc_auc", "model")))
    listed = comparison.agg(ordered.alias("rows"))  # a row per model
    falling = F.forall(
        F.sequence(F.lit(1), F.size("rows") - 1),
        lambda i: F.col("rows")[i - 1]["roc_auc"] >= F.col("rows")[i]["roc_auc"],
    )
    return listed.select(
        F.array_join(F.array_sort("rows.model"), ",").alias("models"),
        F.array_join("rows.rank", ",").alias("ranks"),
        falling.alias("by_auc"),
    )


def _comparison(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(training.train_models(*_parts(spark, sf), KEY, LABEL, overrides=QUICK, anomaly_trees=50).comparison)


def _labelled_parts(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def _training_job(spark: SparkSession, sf: str) -> DataFrame:
    """Every slot at its own size, saved and read again; the comparison with the manifest's counts."""
    train, test = _parts(spark, sf)
    trained = training.train_models(train, test, KEY, LABEL)
    folder = work_dir(spark, "training-run")
    training.save_run(trained, _labelled_parts(train, test), folder)
    saved = tables.read_csv(spark, f"{folder}/model_comparison", trained.comparison.schema)
    info = spark.read.json(f"{folder}/feature_info").select("training_info.train_samples", "training_info.test_samples")
    return _ranked(saved).crossJoin(F.broadcast(info))  # one row each


def _tuned_job(spark: SparkSession, sf: str) -> DataFrame:
    """Search of two slots, thresholds, and all that a tuned run saves."""
    train, test = _parts(spark, sf)
    trained, trials, thresholds = training.tuned_models(
        train, test, KEY, LABEL, tuple(_SMALL_GRIDS), n_iter=2, folds=2, grids=_SMALL_GRIDS
    )
    folder = work_dir(spark, "tuned-run")
    training.save_run(trained, _labelled_parts(train, test), folder, LABEL, trials, thresholds, 2, 2)
    info = spark.read.json(f"{folder}/feature_info")
    facts = info.select(
        "n_iter", "cv_folds", "training_info.train_samples",
        F.col("best_params.xgboost").contains("maxIter").alias("names_parameters"),
    )
    kept = spark.read.parquet(f"{folder}/trials").agg(F.count("*").alias("n_trials"))
    cuts = spark.read.csv(f"{folder}/thresholds", header=True).agg(F.countDistinct("model").alias("n_thresholds"))
    saved = tables.read_csv(spark, f"{folder}/model_comparison", trained.comparison.schema)
    out = _ranked(saved)
    for one in (facts, kept, cuts):
        out = out.crossJoin(F.broadcast(one))  # one row each
    return out


# --- streams ------------------------------------------------------------------------------------


def _message_files(spark: SparkSession, sf: str, files: int = 3) -> str:
    folder = work_dir(spark, "messages")
    fx.transaction_json(spark, sf).select("value").repartition(files).write.text(folder)
    return folder


def scorecards(accepted: DataFrame) -> DataFrame:
    keyed = accepted.withColumn(KEY, F.col("transaction_id").try_cast("long"))
    return fx.with_scorecards(features.add_features(keyed))


def _alerts_of(spark: SparkSession, messages: DataFrame) -> DataFrame:
    return stream.alert_stream(messages, scorecards, MODELS, PARAMS)


def _transaction_stream(spark: SparkSession, sf: str) -> DataFrame:
    out = work_dir(spark, "received")
    source = stream.file_source(spark, _message_files(spark, sf), 1)
    writer = source.writeStream.format("text").option("path", out)
    stream.run_all(writer, work_dir(spark, "received-state"))
    return spark.read.text(out).agg(F.count("*").alias("n"))


def _alert_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Every scored profile as a stream of stored rows, alerts to files."""
    rows = work_dir(spark, "scored")
    scored = fx.model_scores_wide(spark, sf).withColumn("transaction_id", F.col(KEY).cast("string"))
    scored.write.parquet(rows)
    source = spark.readStream.schema(scored.schema).parquet(rows)
    out = work_dir(spark, "alert-sink")
    stream.run_all(stream.file_sink(score_transactions(source, MODELS, PARAMS), out), work_dir(spark, "alert-sink-state"))
    return _saved(tables.read_alerts(spark, out, array_file=False))


def _scoring_stream(spark: SparkSession, sf: str) -> DataFrame:
    out = work_dir(spark, "stream-alerts")
    alerts = _alerts_of(spark, stream.file_source(spark, _message_files(spark, sf), 1))
    stream.run_all(stream.file_sink(alerts, out), work_dir(spark, "stream-alerts-state"))
    return _flat_alerts(tables.read_alerts(spark, out, array_file=False))


def _reject_stream(spark: SparkSession, sf: str) -> DataFrame:
    alerts, rejects = work_dir(spark, "split-alerts"), work_dir(spark, "split-rejects")
    source = stream.file_source(spark, _message_files(spark, sf), 1)
    writer = stream.split_batches(source, scorecards, MODELS, PARAMS, alerts, rejects)
    stream.run_all(writer, work_dir(spark, "split-state"))
    read = spark.read.schema("message string, reject_reason string").json(f"{rejects}/batch=*")
    return read.groupBy("reject_reason").agg(F.count("*").alias("n"))


def _paced(spark: SparkSession, rows: DataFrame, purpose: str) -> tuple[DataFrame, int]:
    """A table's rows as a stream that takes about three seconds to come, and their number."""
    folder = work_dir(spark, purpose)
    # Row groups of a few megabytes, since a task that replays a part of one reads it from its first row.
    rows.repartition(4).write.option("parquet.block.size", 4 << 20).parquet(folder)
    n = spark.read.parquet(folder).count()
    return replay.replayed(spark, folder, max(1.0, n / 3)), n


def _published_alerts(spark: SparkSession, sf: str) -> DataFrame:
    messages, n = _paced(spark, fx.transaction_json(spark, sf).select("value"), "paced-messages")
    alerts, out = _alerts_of(spark, messages), work_dir(spark, "published")
    stream.run_for(replay.publishing(wire.to_alert_json(alerts), out), work_dir(spark, "published-state"), n)
    sent = replay.published(spark, out, "key string, value string")
    return _flat_alerts(sent.select(F.from_json("value", alerts.schema).alias("alert")).select("alert.*"))


def _paced_replay(spark: SparkSession, sf: str) -> DataFrame:
    sent = fx.credit_profile(spark, sf).select(wire.to_transaction_json(KEY, F.current_timestamp()).alias("value"))
    messages, n = _paced(spark, sent, "paced-table")
    ids, out = wire.accepted(wire.decode_transactions(messages)).select("transaction_id"), work_dir(spark, "paced")
    stream.run_for(replay.publishing(ids, out), work_dir(spark, "paced-state"), n)
    found = replay.published(spark, out, ids.schema)
    return found.agg(F.count("*").alias("n"), F.countDistinct("transaction_id").alias("n_distinct"))


def _complete(spark: SparkSession, aggregated: DataFrame, purpose: str) -> DataFrame:
    """Run a stateful aggregation over all input and read its final state.

    Each micro-batch's whole result replaces the one before it.
    """
    out = work_dir(spark, purpose)

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    writer = aggregated.writeStream.outputMode("complete").foreachBatch(replace)
    stream.run_all(writer, work_dir(spark, f"{purpose}-state"))
    return spark.read.parquet(out)


def _running_totals(spark: SparkSession, sf: str) -> DataFrame:
    source = stream.file_source(spark, _message_files(spark, sf), 1)
    predicted = stream.scored_stream(source, scorecards, MODELS, PARAMS)
    return _complete(spark, stream.running_totals(predicted, PARAMS), "totals")


def _scored_events(events: DataFrame) -> DataFrame:
    return events.select(F.col("ts").cast("timestamp").alias("ts"), (F.col("value") / 500.0).alias("risk_score"))


def _window_rows(report: DataFrame) -> DataFrame:
    second = F.unix_seconds("window_start").alias("window_second")
    return tidy(report.select(second, "processed", "alerts", "mean_score"))


def _report_windows(spark: SparkSession, sf: str) -> DataFrame:
    return _window_rows(metrics.report_windows(_scored_events(table(spark, sf, "events"))))


def _arriving_events(spark: SparkSession, sf: str, late_seconds: int = 600) -> DataFrame:
    """The event table as a stream of several micro-batches, up to ten minutes out of order."""
    folder = work_dir(spark, "arrivals")
    schema = fx.arrivals(spark, table(spark, sf, "events"), folder, late_seconds=late_seconds)
    return stream.table_source(spark, folder, schema)


def _appended(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    """Run a stream over all its input and read what it wrote."""
    out = work_dir(spark, purpose)
    writer = rows.writeStream.format("parquet").option("path", out).outputMode("append")
    stream.run_all(writer, work_dir(spark, f"{purpose}-state"))
    return spark.read.schema(rows.schema).parquet(out)


def _report_windows_stream(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scored_events(_arriving_events(spark, sf)).withWatermark("ts", "10 minutes")
    return _window_rows(_appended(spark, metrics.report_windows(scored), "windows"))


def _timed_events(events: DataFrame) -> DataFrame:
    """Events as scored transactions with a duration, an agreement and one model's time."""
    whole = lambda factor: F.floor(F.col("value") * factor).cast("long")
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("value") / 500.0).alias("risk_score"),
        whole(100.0).alias("duration_us"),
        (F.lit(1.0) - F.col("value") / 1000.0).alias("agreement"),
        F.when(F.col("event_type").isNotNull(), F.create_map("event_type", whole(40.0))).alias("model_us"),
    )


def _report_rows(rows: DataFrame) -> DataFrame:
    each = F.transform("models", lambda m: F.format_string("%s %d %d %.3f %.3f %.3f", m["model"], m["calls"], m["mean_us"], m["p50_us"], m["p95_us"], m["p99_us"]))
    flat = rows.withColumns({
        "window_second": F.unix_seconds("window_start"),
        "score_buckets": F.array_join(F.transform("score_buckets", lambda n: n.cast("string")), ","),
        "models": F.array_join(each, "; "),
    })
    return tidy(flat.drop("window_start"))


def _full_report(spark: SparkSession, sf: str) -> DataFrame:
    return _report_rows(report.full_report(_timed_events(table(spark, sf, "events"))))


def _full_report_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = report.full_report(_timed_events(_arriving_events(spark, sf)).withWatermark("ts", "10 minutes"))
    return _report_rows(_appended(spark, rows, "report"))


def _arriving_timings(spark: SparkSession, sf: str) -> DataFrame:
    return _arriving_events(spark, sf, late_seconds=1).select(
        "event_id", "ts", F.col("event_type").alias("model"), F.floor(F.col("value") * 100.0).cast("long").alias("duration_us")
    )


def _history_run(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Folders of the statistics that the history stream gave, and of its state."""
    out, state = work_dir(spark, "history"), work_dir(spark, "history-state")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    found = recent_history_stream(_arriving_timings(spark, sf), HISTORY_CAPS["model"])
    stream.run_all(found.writeStream.outputMode("update").foreachBatch(write), state)
    return out, state


def _history_stream(spark: SparkSession, sf: str) -> DataFrame:
    _, state = _history_run(spark, sf)
    return read_history(spark, state).select(F.col("id").cast("long").alias("event_id"), F.col("key").alias("model"), F.col("us").alias("duration_us"))


def _history_stats_stream(spark: SparkSession, sf: str) -> DataFrame:
    out, _ = _history_run(spark, sf)
    rows = spark.read.parquet(out)
    last = rows.groupBy("key").agg(F.max_by(F.struct(*rows.drop("key", "batch").columns), "pushed").alias("last"))
    return last.select(F.col("key").alias("model"), "last.*")


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    """Labels with their alerts from two streams: labels up to an hour around their alerts, every fifth alert twice."""
    start = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("c_custkey") * 60)
    labels = fx.credit_profile(spark, sf).select(
        F.col("c_custkey").cast("string").alias("transaction_id"), "is_default",
        (start + F.make_dt_interval(mins=F.pmod(F.col("c_custkey") * 17, F.lit(100)) - 40)).alias("ts"),
    )
    number = F.col("transaction_id").cast("long")
    sent = F.timestamp_seconds(F.lit(1_700_000_000) + number * 60)
    sent_alerts = work_dir(spark, "sent-alerts")  # kept, since every fifth is read once more
    fx.alerts(spark, sf).select("transaction_id", "risk_level", "risk_score", sent.alias("ts")).write.parquet(sent_alerts)
    alerts = spark.read.parquet(sent_alerts)
    earlier = alerts.filter(number % 5 == 0).withColumns({"risk_score": F.lit(1.0), "risk_level": F.lit("critical"), "ts": F.col("ts") - F.expr("interval 3 minutes")})
    sides = []
    for name, rows in (("labels", labels), ("alerts", alerts.unionByName(earlier))):
        folder = work_dir(spark, f"arriving-{name}")
        schema = fx.arrivals(spark, rows, folder, batches=3)
        sides.append(stream.table_source(spark, folder, schema))
    found = _appended(spark, quality.labels_with_alerts(*sides), "judged")
    return found.filter("transaction_id is not null")


def _judged_labels(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_judged(spark, sf).select("transaction_id", "is_default", "predicted_score", "has_alert"))


def _judged_alerts(label: int) -> Query:
    return lambda spark, sf: _judged(spark, sf).filter(f"has_alert and is_default = {label}").select("transaction_id", "alert.risk_level")


def _judged_misses(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(spark, sf).filter("not has_alert and is_default = 1").select("transaction_id")


def _judged_quality(spark: SparkSession, sf: str) -> DataFrame:
    found = _judged(spark, sf)
    seen = found.filter("has_alert").select("transaction_id", F.col("predicted_score").alias("risk_score"))
    return tidy(ranking.alert_quality(found.select("transaction_id", "is_default"), seen))


def _stream_velocity(spark: SparkSession, sf: str) -> DataFrame:
    found = _appended(spark, velocity_stream(_arriving_events(spark, sf)), "velocity")
    return tidy(found.withColumns({n: F.round(n, 4) for n in ("tx_amount_last_hour", "tx_amount_last_24h")}))


def _progress(spark: SparkSession, sf: str) -> DataFrame:
    source = stream.file_source(spark, _message_files(spark, sf), 1)
    predicted = stream.observed(stream.scored_stream(source, scorecards, MODELS, PARAMS))
    out = work_dir(spark, "progress")
    writer = predicted.select("transaction_id", "risk_score").writeStream.format("parquet").option("path", out)
    seen = stream.run_and_count(spark, writer, work_dir(spark, "progress-state"))
    return spark.range(1).select(F.lit(seen).cast("long").alias("processed"))


def _restarted(spark: SparkSession, sf: str) -> DataFrame:
    """Half the files, a stop, the other half, and a third start with nothing new."""
    folder, landing = _message_files(spark, sf, 2), work_dir(spark, "landing")
    out, state = work_dir(spark, "restart-alerts"), work_dir(spark, "restart-state")
    messages = spark.read.text(folder)
    for half in (0, 1, None):
        if half is not None:
            part = messages.filter(F.pmod(F.hash("value"), F.lit(2)) == half)
            part.write.mode("append").text(landing)
        stream.run_all(stream.file_sink(_alerts_of(spark, stream.file_source(spark, landing)), out), state)
    return _flat_alerts(tables.read_alerts(spark, out, array_file=False))


def _replayed(spark: SparkSession, sf: str) -> DataFrame:
    """A labelled table written as wire messages and replayed file by file."""
    folder, out = work_dir(spark, "replay"), work_dir(spark, "replayed")
    profile = fx.credit_profile(spark, sf)
    sent = profile.select(wire.to_transaction_json(KEY, F.current_timestamp()).alias("value"))
    sent.repartition(4).write.text(folder)
    decoded = wire.accepted(wire.decode_transactions(stream.file_source(spark, folder, 2)))
    writer = decoded.select("transaction_id").writeStream.format("parquet").option("path", out)
    stream.run_all(writer, work_dir(spark, "replay-state"))
    return spark.read.parquet(out).agg(
        F.count("*").alias("n"), F.countDistinct("transaction_id").alias("n_distinct")
    )


def catalogue() -> dict[str, Query]:
    return {
        "a8_transaction_stream": _transaction_stream,
        "a9_alert_sink": _alert_sink,
        "d1_score_with_model": _fit_and_score("xgboost"),
        "d2_score_batch": _batch_scores,
        "f4_top_importances": _top_importances,
        "e3_recent_latency_stream": _history_stats_stream,
        "e4_recent_history_stream": _history_stream,
        "e22_alert_quality_stream": _judged_quality,
        "g1_labels_with_alerts_stream": _judged_labels,
        "g2_right_alerts_stream": _judged_alerts(1),
        "g2_false_alerts_stream": _judged_alerts(0),
        "g3_labels_without_alert_stream": _judged_misses,
        "j3_boosted_xgboost": _fit_and_score("xgboost"),
        "j3_boosted_lightgbm": _fit_and_score("lightgbm"),
        "j3_boosted_catboost": _fit_and_score("catboost"),
        "j4_early_stopping": _early_stopping,
        "j4_staged_stopping": _staged_stopping,
        "j5_random_forest": _fit_and_score("random_forest"),
        "j6_isolation_forest": _isolation,
        "j7_random_search": _search,
        "j7_penalised_leaves": _penalised_search,
        "j8_best_parameters": _best_trials,
        "j9_validation_auc": _validation_auc,
        "j10_model_comparison": _comparison,
        "j11_importances": _importances,
        "j12_save_load": _save_load,
        "j13_training_job": _training_job,
        "j13_tuned_job": _tuned_job,
        "k1_scoring_stream": _scoring_stream,
        "k2_reject_stream": _reject_stream,
        "k3_running_totals": _running_totals,
        "k4_report_windows": _report_windows,
        "k4_report_windows_stream": _report_windows_stream,
        "k4_full_report": _full_report,
        "k4_full_report_stream": _full_report_stream,
        "k5_progress": _progress,
        "k6_restarted_stream": _restarted,
        "k6_published_alerts": _published_alerts,
        "k7_replayed_table": _replayed,
        "k7_paced_table": _paced_replay,
        "l_stream_velocity": _stream_velocity,
    }
