"""The query catalogue: every operator applied to the given tables.

Outputs are flat and rounded, so that they can be compared with the statements of
:mod:`riskloom.plans.oracles`, which use the same names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import features, scoring
from riskloom.functions.features import (
    BILL_COLUMNS,
    CATEGORICAL_FEATURES,
    ENGINEERED_FEATURES,
    FEATURE_NAMES,
    PAID_COLUMNS,
    PAY_COLUMNS,
)
from riskloom.operators import (
    clean,
    ensemble,
    evaluation,
    matrix,
    metrics,
    ranking,
    splits,
    velocity,
)
from riskloom.params import MODELS, THRESHOLDS, WEIGHTS, ScoringParams
from riskloom.plans import fixtures as fx
from riskloom.plans.scoring import score_transactions
from riskloom.session import work_dir
from riskloom.sources import tables, wire
from riskloom.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
PARAMS = ScoringParams()
KEY = "c_custkey"
AMOUNTS = ("limit_bal", *BILL_COLUMNS, *PAID_COLUMNS)
PROFILE = ("limit_bal", "sex", "education", "marriage", "age", *PAY_COLUMNS, *BILL_COLUMNS, *PAID_COLUMNS)


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column."""
    return df.selectExpr(
        *[f"round(`{c}`, {places}) as `{c}`" if t == "double" else f"`{c}`" for c, t in df.dtypes]
    )


def joined(items: Column) -> Column:
    return F.array_join(items, ",")


def wide() -> dict[str, Column]:
    """Model columns, null where a model failed."""
    return {m: F.col(m) for m in MODELS}


def filled() -> dict[str, Column]:
    return scoring.neutral_if_failed(wide())


def key() -> Column:
    return F.col(KEY)


# --- A: sources, sinks, wire format -------------------------------------------------------------


def _parquet_scan(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(tables.read_parquet(spark, f"{sf}/customer.parquet").select("c_custkey", "c_nationkey", "c_acctbal"))


def _csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "credit-csv")
    fields = dict(zip(tables.CREDIT_SCHEMA.fieldNames(), ("c_custkey", *PROFILE, "is_default"), strict=True))
    profile = fx.credit_profile(spark, sf)
    profile.select(*[F.col(source).alias(name) for name, source in fields.items()]).write.csv(path, header=True)
    read = tables.read_csv(spark, path)
    return tidy(read.withColumnsRenamed({n: n.lower() for n in read.columns}).withColumnRenamed("default.payment.next.month", "label"))


def _split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.stratified_split(fx.credit_profile(spark, sf), "c_custkey", "is_default")


def _train_test_load(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_dir(spark, "train-test")
    _split(spark, sf).write.partitionBy("split").parquet(f"{folder}/parts")
    parts = spark.read.parquet(f"{folder}/parts")
    for name in ("train", "test"):
        parts.filter(F.col("split") == name).write.parquet(f"{folder}/{name}.parquet")
    train, test = tables.read_train_test(spark, folder)
    return (
        train.unionByName(test)
        .groupBy("split")
        .agg(F.count("*").alias("n_rows"), F.sum("is_default").alias("n_default"))
    )


def _decoded(spark: SparkSession, sf: str) -> DataFrame:
    return wire.decode_transactions(fx.transaction_json(spark, sf))


def _decode_accepted(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(wire.accepted(_decoded(spark, sf)).select("transaction_id", *PROFILE))


def _decode_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return wire.rejected(_decoded(spark, sf)).groupBy("reject_reason").agg(F.count("*").alias("n"))


def _default_event_time(spark: SparkSession, sf: str) -> DataFrame:
    accepted = wire.accepted(_decoded(spark, sf))
    recent = F.col("timestamp") <= F.current_timestamp()
    return accepted.agg(F.count("*").alias("n"), F.count_if(recent).alias("n_with_time"))


def _alert_json(spark: SparkSession, sf: str) -> DataFrame:
    value = F.from_json("value", tables.ALERT_SCHEMA)
    read = wire.to_alert_json(fx.alerts(spark, sf)).select(value.alias("a"))
    return tidy(
        read.select(
            "a.transaction_id",
            "a.risk_score",
            "a.risk_level",
            F.col("a.model_scores.catboost").alias("catboost"),
            "a.credit_limit",
            "a.customer_info",
        )
    )


def _latest_alerts(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_dir(spark, "alert-saves")
    alerts = fx.alerts(spark, sf)
    tables.write_alerts(alerts.filter(F.col("risk_level") == "critical"), f"{folder}/alerts_20240101_000000")
    tables.write_alerts(alerts, f"{folder}/alerts_20240102_000000")
    return _saved(tables.read_latest_alerts(spark, folder, array_file=False))


def _saved(alerts: DataFrame) -> DataFrame:
    return tidy(alerts.select("transaction_id", "risk_score", "risk_level"))


def _saved_alerts(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "alerts")
    tables.write_alerts(fx.alerts(spark, sf), path)
    return _saved(tables.read_alerts(spark, path, array_file=False))


def _wire_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(fx.credit_profile(spark, sf).select(*wire.wire_fields("c_custkey")))


def _first_rows(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(tables.first_rows(fx.credit_profile(spark, sf).select("c_custkey", "limit_bal"), "c_custkey", 150))


def _metrics_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "metrics")
    results = tidy(_results(spark, sf))
    tables.write_metrics(results, path)
    return tables.read_csv(spark, path, results.schema)


def _split_tables(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "splits")
    tables.write_split(_split(spark, sf), "is_default", path)
    labels = spark.read.parquet(f"{path}/labels").join(spark.read.parquet(f"{path}/features").drop("split"), "c_custkey")
    return labels.groupBy("split").agg(F.count("*").alias("n_rows"), F.sum("is_default").alias("n_default"))


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "manifest")
    row = tables.manifest(
        _split(spark, sf), "is_default", matrix.NUMERIC, CATEGORICAL_FEATURES, {"optimal_thresholds": THRESHOLDS}
    )
    tables.write_manifest(row, path)
    read = spark.read.schema(row.schema).json(path)
    return tidy(read.select("n_features", "target", "training_info.*"))


# --- B: cleaning --------------------------------------------------------------------------------


def _rename_drop(spark: SparkSession, sf: str) -> DataFrame:
    raw = fx.credit_profile(spark, sf).select(
        key().alias("ID"), F.col("pay_0").alias("PAY_0"), F.col("pay_2"), F.col("is_default").alias("default.payment.next.month")
    )
    return clean.rename_and_drop(raw).withColumnRenamed("PAY_1", "pay_1")


def _profile_query(transform: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: transform(fx.credit_profile(spark, sf))


def _predicted(spark: SparkSession, sf: str) -> DataFrame:
    score = scoring.weighted_mean(filled(), PARAMS.weights, PARAMS.default_weight)
    return fx.model_scores_wide(spark, sf).withColumn("risk_score", score)


# --- C: features --------------------------------------------------------------------------------


def _feature(name: str, ddof: int = 1) -> Query:
    return _profile_query(
        lambda df: tidy(df.select("c_custkey", features.engineered(ddof=ddof)[name].alias(name)))
    )


def _summary_features(spark: SparkSession, sf: str) -> DataFrame:
    profile = fx.credit_profile(spark, sf).withColumnRenamed("pay_0", "pay_1")
    return tidy(features.add_summary_features(profile).select("c_custkey", *features.SUMMARY_FEATURES))


def _feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(matrix.feature_matrix(fx.featured_profile(spark, sf), ["c_custkey"]))


def _standardised(spark: SparkSession, sf: str) -> DataFrame:
    featured = fx.featured_profile(spark, sf)
    return tidy(matrix.apply_scaler(featured, matrix.fit_scaler(featured), ["c_custkey"]))


def _train_test_matrices(spark: SparkSession, sf: str) -> DataFrame:
    parts = features.add_features(_split(spark, sf))
    train, test = (parts.filter(F.col("split") == s) for s in ("train", "test"))
    return tidy(DataFrame.unionByName(*matrix.prepare_train_test(train, test, keep=["split", "c_custkey"])))


# --- L: velocity --------------------------------------------------------------------------------


def _velocity(name: str, places: int = 6) -> Query:
    return lambda spark, sf: tidy(velocity.velocity_features(table(spark, sf, "events"), [name]), places)


def _calendar(spark: SparkSession, sf: str) -> DataFrame:
    return velocity.calendar_fields(table(spark, sf, "events")).select("event_id", "hour_of_day", "day_of_week")


# --- D: scoring ---------------------------------------------------------------------------------


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return fx.labelled_scores_wide(spark, sf)


def _score_column(name: str, build: Callable[[], Column]) -> Query:
    return lambda spark, sf: tidy(_scores(spark, sf).select("id", build().alias(name)))


def _map_column(name: str, build: Callable[[Column], Column]) -> Query:
    return _score_column(name, lambda: build(scoring.score_map(wide())))


def _long(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: tidy(build(fx.model_scores(spark, sf)))


def _normalised(shape: str) -> Query:
    """One model's output in the shapes a runtime may return, by turns."""

    def probability() -> Column:
        p, turn = F.col("xgboost"), F.col("id") % 3
        if shape == "map":
            both = F.create_map(F.lit(0), 1.0 - p, F.lit(1), p)
            only_zero = F.create_map(F.lit(0), 1.0 - p)
            empty = F.create_map().cast("map<int,double>")
            return scoring.probability_from_map(
                F.when(turn == 0, both).when(turn == 1, only_zero).otherwise(empty)
            )
        empty = F.array().cast("array<double>")
        return scoring.probability_from_array(
            F.when(turn == 0, F.array(1.0 - p, p)).when(turn == 1, F.array(p)).otherwise(empty)
        )

    return _score_column("probability", probability)


def _with_table(build: Callable[[DataFrame, DataFrame], DataFrame], weights: dict[str, float]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        parameters = ensemble.parameter_table(spark, weights, "weight")
        return tidy(build(fx.model_scores(spark, sf), parameters))

    return run


def _changed_weights(spark: SparkSession, sf: str) -> DataFrame:
    base = ensemble.parameter_table(spark, {m: w for m, w in WEIGHTS.items() if m != "catboost"}, "weight")
    return tidy(ensemble.weighted_mean(fx.model_scores(spark, sf), ensemble.override(base, "xgboost", 0.5)))


def _strategy(params: ScoringParams, models: tuple[str, ...] = MODELS) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        prediction = scoring.predict({m: F.col(m) for m in models}, params)
        predicted = _scores(spark, sf).select("id", prediction.alias("p"))
        return tidy(
            predicted.select(
                "id",
                "p.risk_score",
                F.size("p.model_scores").alias("n_models"),
                joined(F.col("p.triggered_features")).alias("triggered"),
            )
        )

    return run


def _primary_absent(spark: SparkSession, sf: str) -> DataFrame:
    return _strategy(ScoringParams(strategy="primary", primary_model="absent"))(spark, sf)


def _threshold_lookup(spark: SparkSession, sf: str) -> DataFrame:
    known = {m: t for m, t in THRESHOLDS.items() if m != "lightgbm"}
    table_ = ensemble.parameter_table(spark, known, "threshold")
    looked_up = ensemble.lookup(fx.model_scores(spark, sf), table_, "threshold", 0.61)
    over = scoring.at_least(F.col("score"), F.col("threshold"))
    return looked_up.groupBy("model", "threshold").agg(F.count_if(over).alias("n_over"))


def _flat_alerts(alerts: DataFrame) -> DataFrame:
    return tidy(
        alerts.select(
            "transaction_id",
            "risk_score",
            "risk_level",
            joined(F.col("triggered_features")).alias("triggered"),
            "credit_limit",
            "customer_info",
            "context",
        )
    )


def scoring_job(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of all profiles, sent as JSON messages."""
    return score_messages(fx.transaction_json(spark, sf))


def score_messages(messages: DataFrame) -> DataFrame:
    """JSON messages in, alerts out: decode, featurise, score, decide, explain."""
    accepted = wire.accepted(wire.decode_transactions(messages))
    keyed = accepted.withColumn("c_custkey", F.col("transaction_id").try_cast("long"))
    scored = fx.with_scorecards(features.add_features(keyed))
    return score_transactions(scored, MODELS, PARAMS)


def _anomaly_probability(spark: SparkSession, sf: str) -> DataFrame:
    raw = fx.featured_profile(spark, sf).select(key().alias("id"), (-F.col("utilization_ratio")).alias("raw"))
    return tidy(metrics.anomaly_probability(raw, "raw").select("id", "anomaly_score"))


def _anomaly_flag(spark: SparkSession, sf: str) -> DataFrame:
    raw = fx.featured_profile(spark, sf).select(
        key().alias("id"), "is_default", (-F.col("utilization_ratio")).alias("raw")
    )
    return metrics.anomaly_flag(raw, "raw", clean.normal_only(raw), 0.1).select("id", "is_anomaly")


# --- E: metrics and evaluation ------------------------------------------------------------------


def _agreements(spark: SparkSession, sf: str) -> DataFrame:
    return _predicted(spark, sf).withColumn("agreement", scoring.wide_agreement(filled()))


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(metrics.pipeline_summary(_agreements(spark, sf), fx.timings(spark, sf), PARAMS.alert_threshold))


def _evaluated(build: Callable[[DataFrame], DataFrame], places: int = 6) -> Query:
    return lambda spark, sf: tidy(build(fx.evaluated_scores(spark, sf)), places)


def _curve(build: Callable[[DataFrame], DataFrame]) -> Query:
    """Curve points with the threshold at the precision scores are compared at."""
    return lambda spark, sf: tidy(build(fx.evaluated_scores(spark, sf)), 8)


def _ties(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: tidy(build(fx.document_scores(spark, sf)))


def _results(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.evaluate(fx.evaluated_scores(spark, sf))


def _business(spark: SparkSession, sf: str) -> DataFrame:
    scores = fx.labelled_scores_wide(spark, sf)
    columns = {**wide(), "ensemble": scoring.weighted_mean(filled(), WEIGHTS)}
    rounded = scores.withColumns({m: F.round(F.coalesce(c, F.lit(0.5)), 8) for m, c in columns.items()})
    long = ensemble.to_long(
        rounded.withColumnRenamed("limit_bal", "amount"), list(columns), ["id", "label", "amount"]
    )
    business = evaluation.business_metrics(long)
    return business.select(
        *[
            F.round(c, 6 if c.endswith("rate") else 2).alias(c) if c != "model" else F.col(c)
            for c in business.columns
        ]
    )


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return fx.credit_profile(spark, sf).select(
        key().cast("string").alias("transaction_id"), "is_default", "pay_0", "limit_bal"
    )


def _alerts_vs_labels(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: tidy(build(_labels(spark, sf), fx.alerts(spark, sf)))


def _false_alarm(definition: str) -> Query:
    def rates(scores: DataFrame) -> DataFrame:
        rate = evaluation.false_alarm_rate(evaluation.counts(), definition)
        return evaluation.confusion(scores).select("model", rate.alias("false_alarm_rate"))

    return _evaluated(rates)


def _split_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).select("split", F.col("is_default").alias("label"))


# --- F, G, H, I: ranking, joins, reshaping, splits ----------------------------------------------


def _ranked(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: tidy(build(_results(spark, sf)))


_SHOWN = ("transaction_id", "risk_score", "risk_level")


def _top(label: int, n: int) -> Query:
    return _alerts_vs_labels(
        lambda labels, alerts: ranking.top_alerts(ranking.alerts_with_label(labels, alerts, label), n).select(*_SHOWN)
    )


def _missed(labels: DataFrame, alerts: DataFrame) -> DataFrame:
    rows = ranking.missed(labels, alerts).withColumn("order", ranking.id_order())
    return tables.first_rows(rows, "order", 5).select("transaction_id", "pay_0", "limit_bal")


def _scores_in_order(spark: SparkSession, sf: str) -> DataFrame:
    names = F.transform(scoring.scores_descending(F.col("model_scores")), lambda e: e["key"])
    return fx.alerts(spark, sf).select("transaction_id", F.array_join(names, ">").alias("ordered_models"))


def _parameter_lookup(spark: SparkSession, sf: str) -> DataFrame:
    known = ensemble.parameter_table(spark, {"xgboost": 0.25, "catboost": 0.25, "lightgbm": 0.2}, "weight")
    return tidy(ensemble.lookup(fx.model_scores(spark, sf), known, "weight", 0.1).select("id", "model", "weight"))


def _append_ensemble(spark: SparkSession, sf: str) -> DataFrame:
    predicted = _predicted(spark, sf).withColumn("id", key())
    models = ensemble.to_long(predicted, MODELS)
    combined = predicted.select("id", F.lit("ensemble").alias("model"), F.col("risk_score").alias("score"))
    return tidy(models.unionByName(combined))


def _score_maps(spark: SparkSession, sf: str) -> DataFrame:
    maps = ensemble.to_map(fx.model_scores(spark, sf), MODELS)
    shown = F.transform(F.map_entries("model_scores"), lambda e: F.format_string("%s=%.4f", e["key"], e["value"]))
    return maps.select("id", joined(shown).alias("scores"))


def _exploded_maps(spark: SparkSession, sf: str) -> DataFrame:
    maps = _scores(spark, sf).select("id", scoring.score_map(wide()).alias("model_scores"))
    return tidy(ensemble.from_map(maps))


def _validation(spark: SparkSession, sf: str) -> DataFrame:
    train = _split(spark, sf).filter(F.col("split") == "train").select("c_custkey", "is_default")
    return splits.validation_split(train, "c_custkey", "is_default").select("c_custkey", "split")


def _class_weights(mode: str) -> Query:
    from riskloom.operators import learn

    def run(spark: SparkSession, sf: str) -> DataFrame:
        weighted = learn.with_class_weight(fx.credit_profile(spark, sf), "is_default", mode)
        return tidy(weighted.groupBy(F.col("is_default").alias("label"), "weight").agg(F.count("*").alias("n")))

    return run


def catalogue() -> dict[str, Query]:
    """Every registered query by name."""
    out: dict[str, Query] = {
        "a1_parquet_scan": _parquet_scan,
        "a2_csv_scan": _csv_scan,
        "a3_train_test_load": _train_test_load,
        "a4_decode_accepted": _decode_accepted,
        "a4_decode_rejected": _decode_rejected,
        "a5_default_event_time": _default_event_time,
        "a6_alert_json": _alert_json,
        "a7_latest_alerts": _latest_alerts,
        "a10_wire_transactions": _wire_transactions,
        "a11_first_rows": _first_rows,
        "a12_metrics_csv": _metrics_csv,
        "a13_split_tables": _split_tables,
        "a14_manifest": _manifest,
        "a15_saved_alerts": _saved_alerts,
        "b1_rename_drop": _rename_drop,
        "b2_recode_education": _profile_query(lambda df: df.select("c_custkey", clean.recode_education().alias("education"))),
        "b3_recode_marriage": _profile_query(lambda df: df.select("c_custkey", clean.recode_marriage().alias("marriage"))),
        "b4_fill_missing": _long(lambda s: clean.fill_missing(s, ["score"]).select("id", "model", "score")),
        "b5_alert_filter": lambda spark, sf: tidy(
            clean.alerts_only(_predicted(spark, sf), PARAMS.alert_threshold).select("c_custkey", "risk_score")
        ),
        "b6_normal_rows": _profile_query(lambda df: clean.normal_only(df).select("c_custkey", "is_default")),
        "b7_category_doubles": _profile_query(
            lambda df: clean.as_doubles(df, CATEGORICAL_FEATURES).select("c_custkey", *CATEGORICAL_FEATURES)
        ),
        "b8_binarise": lambda spark, sf: _predicted(spark, sf).select(
            "c_custkey", clean.binarise(F.col("risk_score"), 0.5).alias("predicted")
        ),
        "b9_select_present": _profile_query(
            lambda df: clean.select_present(df, ("missing_one", "age", "pay_2", "missing_two", "is_default"))
        ),
    }
    for i, name in enumerate(ENGINEERED_FEATURES[:12], 1):
        if name != "bill_volatility":
            out[f"c{i}_{name}"] = _feature(name)
    out |= {
        "c7_bill_volatility_sample": _feature("bill_volatility", 1),
        "c7_bill_volatility_pop": _feature("bill_volatility", 0),
        **{
            f"c13_age_group_{policy}": _profile_query(
                lambda df, p=policy: df.select("c_custkey", "age", features.age_group(p).alias("age_group"))
            )
            for policy in features.AGE_POLICIES
        },
        "c14_summary_features": _summary_features,
        "c15_feature_matrix": _feature_matrix,
        "c16_standardised": _standardised,
        "c17_train_test_matrices": _train_test_matrices,
        "l1_tx_count_last_hour": _velocity("tx_count_last_hour"),
        "l2_tx_amount_last_hour": _velocity("tx_amount_last_hour", 4),
        "l3_tx_count_last_24h": _velocity("tx_count_last_24h"),
        "l4_tx_amount_last_24h": _velocity("tx_amount_last_24h", 4),
        "l5_unique_merchants_24h": _velocity("unique_merchants_24h"),
        "l6_avg_tx_amount": _velocity("avg_tx_amount"),
        "l7_failed_tx_last_hour": _velocity("failed_tx_last_hour"),
        "l8_time_since_last_tx": _velocity("time_since_last_tx"),
        "l9_account_age_days": _velocity("account_age_days"),
        "l10_calendar_fields": _calendar,
        "d3_logistic_scorecards": lambda spark, sf: tidy(_scores(spark, sf).select("id", *MODELS)),
        "d4_normalised_from_map": _normalised("map"),
        "d4_normalised_from_array": _normalised("array"),
        "d5_weighted_mean": _score_column("ensemble", lambda: scoring.weighted_mean(wide(), WEIGHTS)),
        "d5_weighted_mean_long": _with_table(ensemble.weighted_mean, WEIGHTS),
        "d6_equal_mean": _score_column("ensemble", lambda: scoring.equal_mean(wide())),
        "d7_changed_weights": _changed_weights,
        "d8_gated_mean": _with_table(lambda s, w: ensemble.gated_mean(s, w, 0.5), WEIGHTS),
        "d9_max_score": _map_column("max_score", scoring.max_score),
        "d10_min_score": _map_column("min_score", scoring.min_score),
        "d11_median_score": _map_column("median_score", scoring.median_score),
        "d12_voting_score": _map_column("votes", lambda m: scoring.voting_score(m, 0.5)),
        "d13_known_weight_mean": _with_table(
            ensemble.known_weight_mean, {m: w for m, w in WEIGHTS.items() if m != "lightgbm"}
        ),
        "d14_plain_mean": _long(ensemble.plain_mean),
        "d15_primary_strategy": _strategy(ScoringParams(strategy="primary", primary_model="lightgbm")),
        "d15_primary_absent": _primary_absent,
        "d16_ensemble_strategy": _strategy(PARAMS),
        "d17_threshold_lookup": _threshold_lookup,
        "d18_triggered": _score_column("triggered", lambda: joined(scoring.triggered(filled(), 0.56))),
        "d19_risk_level": lambda spark, sf: _predicted(spark, sf).select(
            key().alias("id"), scoring.risk_level(F.col("risk_score")).alias("risk_level")
        ),
        "d20_build_alert": lambda spark, sf: _flat_alerts(fx.alerts(spark, sf)),
        "d21_agreement": _map_column("agreement", lambda _: scoring.agreement(scoring.score_map(filled()))),
        "d22_anomaly_probability": _anomaly_probability,
        "d23_anomaly_flag": _anomaly_flag,
        "d24_scoring_job": lambda spark, sf: _flat_alerts(scoring_job(spark, sf)),
        "e1_alert_rate": lambda spark, sf: tidy(
            metrics.processed_and_alerts(_predicted(spark, sf), PARAMS.alert_threshold)
        ),
        "e2_latency": lambda spark, sf: metrics.latency_stats(fx.timings(spark, sf)),
        "e3_latency_by_model": lambda spark, sf: metrics.latency_stats(fx.timings(spark, sf), ["model"]),
        "e4_recent_history": lambda spark, sf: metrics.recent_history(
            fx.timings(spark, sf), ["ts", "event_id"], "model", ["model"]
        ).select("event_id", "model", "duration_us"),
        "e4_recent_history_all": lambda spark, sf: metrics.recent_history(
            fx.timings(spark, sf), ["ts", "event_id"]
        ).select("event_id", "duration_us"),
        "e5_average_agreement": lambda spark, sf: tidy(metrics.average_agreement(_agreements(spark, sf))),
        "e6_throughput": lambda spark, sf: tidy(metrics.throughput(table(spark, sf, "events"))),
        "e7_score_histogram": lambda spark, sf: tidy(metrics.score_histogram(_predicted(spark, sf))),
        "e8_alerts_by_level": lambda spark, sf: tidy(metrics.alerts_by_level(fx.alerts(spark, sf))),
        "e9_pipeline_summary": _summary,
        "e10_confusion": _evaluated(evaluation.confusion),
        "e11_evaluation": _evaluated(evaluation.evaluate),
        "e12_roc_auc": _evaluated(evaluation.roc_auc),
        "e12_roc_auc_ties": _ties(evaluation.roc_auc),
        "e13_average_precision": _evaluated(evaluation.average_precision),
        "e13_average_precision_ties": _ties(evaluation.average_precision),
        "e14_precision_recall_curve": _curve(evaluation.precision_recall_curve),
        "e15_roc_curve": _curve(evaluation.roc_curve),
        **{
            f"e16_best_threshold_{m}": _evaluated(lambda s, m=m: evaluation.best_threshold(s, m))
            for m in evaluation.METRICS
        },
        "e17_grid_threshold": _evaluated(evaluation.best_grid_threshold),
        "e18_at_threshold_default": _evaluated(lambda s: evaluation.at_threshold(s, 0.5)),
        "e18_at_threshold_configured": _evaluated(lambda s: evaluation.at_threshold(s, 0.61)),
        "e19_default_and_optimal": _evaluated(evaluation.default_and_optimal),
        "e20_classification_report": _evaluated(evaluation.classification_report),
        "e21_business_metrics": _business,
        "e22_alert_quality": _alerts_vs_labels(ranking.alert_quality),
        "e23_alert_score_stats": lambda spark, sf: tidy(metrics.alert_score_stats(fx.alerts(spark, sf))),
        "e24_class_distribution": lambda spark, sf: evaluation.class_distribution(_split_labels(spark, sf)),
        "e25_dataset_stats": lambda spark, sf: tidy(
            evaluation.dataset_stats(_split_labels(spark, sf), len(FEATURE_NAMES))
        ),
        **{
            f"e26_false_alarm_{d}": _false_alarm(d)
            for d in ("fpr", "one_minus_precision", "one_minus_specificity")
        },
        "f1_rank_models": _ranked(lambda r: ranking.compare_models(r).select("model", "roc_auc", "rank")),
        "f2_average_rank": _ranked(ranking.overall_ranking),
        "f3_best_single": _ranked(lambda r: ranking.best_single(r).select("model", *ranking.COMPARED)),
        "f5_top_correct_alerts": _top(1, 5),
        "f6_top_false_alerts": _top(0, 3),
        "f7_missed_positives": _alerts_vs_labels(_missed),
        "f8_scores_in_order": _scores_in_order,
        "f9_head_to_head": _ranked(lambda r: ranking.head_to_head(r, "xgboost", "catboost")),
        "f9_head_to_head_band": _ranked(lambda r: ranking.head_to_head(r, "xgboost", "catboost", 0.001)),
        "f10_win_tally": _ranked(
            lambda r: ranking.win_tally(
                ranking.head_to_head(r, "xgboost", "catboost", 0.001), "xgboost", "catboost"
            )
        ),
        "f11_ensemble_improvement": _ranked(ranking.ensemble_improvement),
        "g1_labels_with_alerts": _alerts_vs_labels(
            lambda labels, alerts: ranking.with_alerts(labels, alerts).drop("pay_0", "limit_bal")
        ),
        "g2_right_alerts": _alerts_vs_labels(
            lambda labels, alerts: ranking.alerts_with_label(labels, alerts, 1).select("transaction_id", "risk_level")
        ),
        "g2_false_alerts": _alerts_vs_labels(
            lambda labels, alerts: ranking.alerts_with_label(labels, alerts, 0).select("transaction_id", "risk_level")
        ),
        "g3_labels_without_alert": _alerts_vs_labels(
            lambda labels, alerts: ranking.missed(labels, alerts).select("transaction_id")
        ),
        "g4_parameter_lookup": _parameter_lookup,
        "g5_append_ensemble": _append_ensemble,
        "h1_metrics_long": _ranked(ranking.metrics_long),
        "h2_scores_wide": _long(lambda s: ensemble.to_wide(s, MODELS)),
        "h3_score_maps": _score_maps,
        "h3_exploded_maps": _exploded_maps,
        "h4_min_max_metrics": _ranked(ranking.min_max_scaled),
        "i1_stratified_split": lambda spark, sf: _split(spark, sf).select("c_custkey", "is_default", "split"),
        "i2_validation_split": _validation,
        "i3_simple_validation_split": _profile_query(
            lambda df: splits.simple_validation_split(df.select("c_custkey"), "c_custkey")
        ),
        "i4_stratified_folds": _profile_query(
            lambda df: splits.stratified_folds(df.select("c_custkey", "is_default"), "c_custkey", "is_default")
        ),
        "j1_positive_weight": _class_weights("positive"),
        "j2_balanced_weights": _class_weights("balanced"),
    }
    return out
