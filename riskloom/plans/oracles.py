"""SQL text that restates each query for a second engine, used to check results.

Every statement is plain SQL over the given tables. Literals are written ``1.2e0`` so that they are
doubles in every engine.
"""

from __future__ import annotations

PAYS = ("pay_0", "pay_2", "pay_3", "pay_4", "pay_5", "pay_6")
BILLS = tuple(f"bill_amt{m}" for m in range(1, 7))
PAID = tuple(f"pay_amt{m}" for m in range(1, 7))
RAW = ("limit_bal", "age", *PAYS, *BILLS, *PAID)
ENGINEERED = (
    "avg_pay_delay", "max_pay_delay", "months_delayed", "pay_trend", "avg_bill_amt", "bill_trend",
    "bill_volatility", "avg_pay_amt", "total_pay_amt", "utilization_ratio", "over_limit",
    "pay_bill_ratio", "age_group",
)
CATEGORIES = ("sex", "education", "marriage")
MODELS = ("xgboost", "catboost", "lightgbm", "random_forest")
WEIGHTS = {"catboost": "0.28e0", "lightgbm": "0.25e0", "random_forest": "0.17e0", "xgboost": "0.30e0"}


def r(expression: str, name: str, places: int = 6) -> str:
    """Rounded output column; adding zero turns a negative zero into a plain one."""
    return f"round(({expression})::DOUBLE, {places}) + 0e0 AS {name}"


def rounded(names, places: int = 6) -> str:
    return ", ".join(r(n, n, places) for n in names)


def _plus(parts) -> str:
    return " + ".join(parts)


# --- shared tables ------------------------------------------------------------------------------

_SLOTS = ", ".join(
    f"max({value}) FILTER (WHERE m = {m}) AS {name}"
    for value, names in (("status", PAYS), ("bill", BILLS), ("paid", PAID))
    for m, name in enumerate(names, 1)
)
_FILLED = ", ".join(
    [f"coalesce({n}, 0)::INTEGER AS {n}" for n in PAYS]
    + [f"coalesce({n}, 0)::DOUBLE AS {n}" for n in (*BILLS, *PAID)]
)
_SPREAD = _plus(f"pow({b} - ({_plus(BILLS)}) / 6e0, 2)" for b in BILLS)

TABLES = {
    "credit_profile": f"""
      SELECT *, CASE WHEN (pay_0 + pay_2 >= 5 AND c_custkey % 4 <> 0) OR c_custkey % 11 = 0
                     THEN 1 ELSE 0 END AS is_default
      FROM (
        SELECT c_custkey, 50000e0 + greatest(c_acctbal, 0e0) * 45e0 AS limit_bal,
               (c_custkey % 2 + 1)::INTEGER AS sex, (c_custkey % 7)::INTEGER AS education,
               (c_custkey % 4)::INTEGER AS marriage, (21 + (c_custkey * 7) % 85)::INTEGER AS age, {_FILLED}
        FROM customer LEFT JOIN (
          SELECT o_custkey, {_SLOTS}
          FROM (
            SELECT o_custkey, m, o_totalprice AS bill, coalesce(l.paid, 0e0) AS paid,
                   CASE WHEN l.l_orderkey IS NULL THEN -1
                        ELSE least(greatest(floor(date_diff('day', o_orderdate, l.last_ship) / 365e0), -2), 8)
                   END::INTEGER AS status
            FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS m
                  FROM orders) s
            LEFT JOIN (SELECT l_orderkey, round(sum(l_extendedprice * (1e0 - l_discount)), 4) AS paid,
                              max(l_shipdate) AS last_ship
                       FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = s.o_orderkey
            WHERE m <= 6)
          GROUP BY o_custkey) w ON w.o_custkey = c_custkey)""",
    "featured": f"""
      SELECT *, ({_plus(PAYS)}) / 6e0 AS avg_pay_delay, greatest({", ".join(PAYS)}) AS max_pay_delay,
             {_plus(f"({p} > 0)::INTEGER" for p in PAYS)} AS months_delayed, pay_0 - pay_6 AS pay_trend,
             ({_plus(BILLS)}) / 6e0 AS avg_bill_amt, bill_amt1 - bill_amt6 AS bill_trend,
             sqrt(({_SPREAD}) / 5e0) AS bill_volatility, sqrt(({_SPREAD}) / 6e0) AS bill_volatility_pop,
             ({_plus(PAID)}) / 6e0 AS avg_pay_amt, {_plus(PAID)} AS total_pay_amt,
             bill_amt1 / (limit_bal + 1e0) AS utilization_ratio, (bill_amt1 > limit_bal)::INTEGER AS over_limit,
             pay_amt1 / (abs(bill_amt1) + 1e0) AS pay_bill_ratio,
             CASE WHEN age > 0 AND age <= 25 THEN 0 WHEN age > 25 AND age <= 35 THEN 1
                  WHEN age > 35 AND age <= 45 THEN 2 WHEN age > 45 AND age <= 55 THEN 3
                  WHEN age > 55 AND age <= 100 THEN 4 ELSE 0 END AS age_group
      FROM credit_profile""",
    "scored": """
      SELECT *, 1e0 / (1e0 + exp(-(-3.5e0 + 1.2e0 * pay_0 + 0.9e0 * pay_2 + 0.3e0 * utilization_ratio))) AS xgboost,
             1e0 / (1e0 + exp(-(-2.5e0 + 1e0 * pay_0 + 0.8e0 * pay_2 + 0.2e0 * months_delayed))) AS catboost,
             CASE WHEN c_custkey % 37 <> 5 THEN
               1e0 / (1e0 + exp(-(-3e0 + 1.1e0 * pay_0 + 0.6e0 * max_pay_delay + 0.2e0 * utilization_ratio)))
             END AS lightgbm,
             1e0 / (1e0 + exp(-(-1e0 + 0.5e0 * avg_pay_delay + 0.5e0 * pay_0 + 0.4e0 * pay_2))) AS random_forest
      FROM featured""",
    "predicted": f"""
      SELECT * EXCLUDE (raw_score), least(greatest(raw_score, 0e0), 1e0) AS risk_score
      FROM (SELECT *, ({_plus(f"coalesce({m}, 0.5e0) * {w}" for m, w in WEIGHTS.items())})
                      / ({_plus(WEIGHTS.values())}) AS raw_score FROM scored)""",
    "levelled": """
      SELECT *, CASE WHEN risk_score >= 0.9e0 THEN 'critical' WHEN risk_score >= 0.7e0 THEN 'high'
                     WHEN risk_score >= 0.5e0 THEN 'medium' ELSE 'low' END AS risk_level FROM predicted""",
    "alerts": "SELECT * FROM levelled WHERE risk_score >= 0.56e0",
    "model_scores": " UNION ALL ".join(
        f"SELECT c_custkey AS id, is_default AS label, '{m}' AS model, {m} AS score FROM scored" for m in MODELS
    ),
    "long_scores": " UNION ALL ".join(
        [f"SELECT c_custkey AS id, is_default AS label, limit_bal, '{m}' AS model, "
         f"round(coalesce({m}, 0.5e0), 8) AS score FROM predicted" for m in MODELS]
        + ["SELECT c_custkey, is_default, limit_bal, 'ensemble', round(risk_score, 8) FROM predicted"]
    ),
    "doc_scores": """
      SELECT doc_id AS id, quality AS label, 'length' AS model,
             round(1e0 / (1e0 + exp(-(n_chars - 3000e0) / 4000e0)), 2) AS score
      FROM labels JOIN documents USING (doc_id)""",
    "timings": "SELECT event_id, ts, event_type AS model, floor(value * 100e0)::BIGINT AS duration_us FROM events",
    "split_profile": """
      SELECT *, CASE WHEN rk <= floor(sz * 0.8e0) THEN 'train' ELSE 'test' END AS split
      FROM (SELECT *, row_number() OVER (PARTITION BY is_default ORDER BY md5(c_custkey::VARCHAR), c_custkey) AS rk,
                   count(*) OVER (PARTITION BY is_default) AS sz FROM credit_profile)""",
}


def _curve_tables(source: str) -> dict[str, str]:
    return {
        "score_table": f"""
          SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
          FROM {source} GROUP BY model, score""",
        "cumulative": """
          SELECT *, (sum(pos) OVER above)::BIGINT AS tp, (sum(neg) OVER above)::BIGINT AS fp,
                 (sum(pos) OVER everything)::BIGINT AS p, (sum(neg) OVER everything)::BIGINT AS n
          FROM score_table
          WINDOW above AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING),
                 everything AS (PARTITION BY model)""",
    }


_PRECISION = "coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0e0)"
_RECALL = "coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0e0)"
_F1 = "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0e0)"
_ACCURACY = "coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0)::DOUBLE, 0e0)"
_COUNTS = """
  count(*) FILTER (WHERE score >= {t} AND label = 1) AS tp, count(*) FILTER (WHERE score >= {t} AND label <> 1) AS fp,
  count(*) FILTER (WHERE score < {t} AND label <> 1) AS tn, count(*) FILTER (WHERE score < {t} AND label = 1) AS fn"""
_AUC = "sum(pos * ((n - fp)::DOUBLE + neg * 0.5e0)) / nullif(max(p)::DOUBLE * max(n), 0)"
_AP = f"sum(pos * {_PRECISION}) / nullif(max(p)::DOUBLE, 0)"

EVALUATED = {
    "counted": "SELECT model, " + _COUNTS.format(t="0.5e0") + " FROM long_scores GROUP BY model",
    "areas": f"SELECT model, {_AUC} AS roc_auc, {_AP} AS pr_auc FROM cumulative GROUP BY model",
    "evaluated": f"""
      SELECT model, {_ACCURACY} AS accuracy, {_PRECISION} AS precision, {_RECALL} AS recall, {_F1} AS f1, roc_auc, pr_auc,
             tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives,
             {_RECALL} AS fraud_detection_rate, coalesce(fp / nullif(fp + tn, 0)::DOUBLE, 0e0) AS false_alarm_rate
      FROM counted JOIN areas USING (model)""",
    "singles": "SELECT * FROM evaluated WHERE model <> 'ensemble'",
}
_EVALUATION_COLUMNS = (
    f"model, {rounded(('accuracy', 'precision', 'recall', 'f1', 'roc_auc', 'pr_auc'))}, true_positives, "
    "false_positives, true_negatives, false_negatives, "
    f"{rounded(('fraud_detection_rate', 'false_alarm_rate'))}"
)

_NEEDS = {
    "featured": ("credit_profile",),
    "scored": ("featured",),
    "predicted": ("scored",),
    "levelled": ("predicted",),
    "alerts": ("levelled",),
    "model_scores": ("scored",),
    "long_scores": ("predicted",),
    "split_profile": ("credit_profile",),
}


def _chain(name: str, done: list[str]) -> None:
    for need in _NEEDS.get(name, ()):
        _chain(need, done)
    if name not in done:
        done.append(name)


def over(tables: str | tuple[str, ...], body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` after the shared tables it needs and any extra ones."""
    names: list[str] = []
    for name in (tables,) if isinstance(tables, str) else tables:
        _chain(name, names)
    parts = [f"{n} AS ({TABLES[n]})" for n in names]
    parts += [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def on_curve(body: str, source: str = "long_scores") -> str:
    return over(source, body, _curve_tables(source))


def on_results(body: str, extra: dict[str, str] | None = None) -> str:
    return over("long_scores", body, {**_curve_tables("long_scores"), **EVALUATED, **(extra or {})})


# --- statements ---------------------------------------------------------------------------------

_PROFILE_COLUMNS = f"{rounded(('limit_bal',))}, sex, education, marriage, age, {', '.join(PAYS)}, {rounded((*BILLS, *PAID))}"
_TRIGGERED = (
    "concat_ws(',', " + ", ".join(
        f"CASE WHEN coalesce({m}, 0.5e0) > 0.56e0 THEN printf('{m}:%.2f', coalesce({m}, 0.5e0)) END"
        for m in sorted(MODELS)) + ")"
)
_ALERT_COLUMNS = f"""
  c_custkey::VARCHAR AS transaction_id, {r('risk_score', 'risk_score')}, risk_level, {_TRIGGERED} AS triggered,
  {r('limit_bal', 'credit_limit')}, 'age_' || age AS customer_info, 'edu_' || education AS context"""


def _source_statements() -> dict[str, str]:
    scored_ids = "c_custkey % 50 > 4"
    wire = f"c_custkey::VARCHAR AS transaction_id, {_PROFILE_COLUMNS}"
    kept_alert = over("alerts", f"SELECT c_custkey::VARCHAR AS transaction_id, {r('risk_score', 'risk_score')}, risk_level FROM alerts")
    sizes = "SELECT split, count(*) AS n_rows, sum(is_default)::BIGINT AS n_default FROM split_profile GROUP BY split"
    return {
        "a1_parquet_scan": f"SELECT c_custkey, c_nationkey, {r('c_acctbal', 'c_acctbal')} FROM customer",
        "a2_csv_scan": over("credit_profile", f"SELECT c_custkey::INTEGER AS id, {_PROFILE_COLUMNS}, is_default AS label FROM credit_profile"),
        "a3_train_test_load": over("split_profile", sizes),
        "a4_decode_accepted": over("credit_profile", f"SELECT {wire} FROM credit_profile WHERE {scored_ids}"),
        "a4_decode_rejected": over("credit_profile", """
            SELECT reject_reason, count(*) AS n FROM (
              SELECT CASE c_custkey % 50 WHEN 0 THEN 'malformed' WHEN 1 THEN 'age' WHEN 2 THEN 'limit_bal'
                          WHEN 3 THEN 'transaction_id' WHEN 4 THEN 'age' END AS reject_reason
              FROM credit_profile) WHERE reject_reason IS NOT NULL GROUP BY reject_reason"""),
        "a5_default_event_time": f"SELECT count(*) AS n, count(*) AS n_with_time FROM customer WHERE {scored_ids}",
        "a6_alert_json": over("alerts", f"""
            SELECT c_custkey::VARCHAR AS transaction_id, {r('risk_score', 'risk_score')}, risk_level,
                   {r('coalesce(catboost, 0.5e0)', 'catboost')}, {r('limit_bal', 'credit_limit')},
                   'age_' || age AS customer_info FROM alerts"""),
        "a7_latest_alerts": kept_alert,
        "a8_transaction_stream": "SELECT count(*) AS n FROM customer",
        "a9_alert_sink": kept_alert,
        "a10_wire_transactions": over("credit_profile", f"SELECT {wire} FROM credit_profile"),
        "a11_first_rows": over("credit_profile", f"SELECT c_custkey, {r('limit_bal', 'limit_bal')} FROM credit_profile ORDER BY c_custkey LIMIT 150"),
        "a12_metrics_csv": on_results(f"SELECT {_EVALUATION_COLUMNS} FROM evaluated"),
        "a13_split_tables": over("split_profile", sizes),
        "a14_manifest": over("split_profile", f"""
            SELECT 36 AS n_features, 'is_default' AS target,
                   count(*) FILTER (WHERE split = 'train') AS train_samples, 0::BIGINT AS val_samples,
                   count(*) FILTER (WHERE split = 'test') AS test_samples,
                   {r("avg(is_default) FILTER (WHERE split = 'train')", 'default_rate')} FROM split_profile"""),
        "a15_saved_alerts": kept_alert,
    }


def _cleaning_statements() -> dict[str, str]:
    p = lambda body: over("credit_profile", body)
    return {
        "b1_rename_drop": p('SELECT pay_0 AS pay_1, pay_2, is_default AS "default" FROM credit_profile'),
        "b2_recode_education": p("SELECT c_custkey, CASE WHEN education IN (0, 5, 6) THEN 4 ELSE education END AS education FROM credit_profile"),
        "b3_recode_marriage": p("SELECT c_custkey, CASE WHEN marriage = 0 THEN 3 ELSE marriage END AS marriage FROM credit_profile"),
        "b4_fill_missing": over("model_scores", f"SELECT id, model, {r('coalesce(score, 0e0)', 'score')} FROM model_scores"),
        "b5_alert_filter": over("predicted", f"SELECT c_custkey, {r('risk_score', 'risk_score')} FROM predicted WHERE risk_score >= 0.56e0"),
        "b6_normal_rows": p("SELECT c_custkey, is_default FROM credit_profile WHERE is_default = 0"),
        "b7_category_doubles": p("SELECT c_custkey, sex::DOUBLE AS sex, education::DOUBLE AS education, marriage::DOUBLE AS marriage FROM credit_profile"),
        "b8_binarise": over("predicted", "SELECT c_custkey, CASE WHEN risk_score >= 0.5e0 THEN 1 ELSE 0 END AS predicted FROM predicted"),
        "b9_select_present": p("SELECT age, pay_2, is_default FROM credit_profile"),
    }


def _feature_statements() -> dict[str, str]:
    f = lambda body: over("featured", body)
    integers = {"max_pay_delay", "months_delayed", "pay_trend", "over_limit"}
    out = {}
    for i, name in enumerate(ENGINEERED[:12], 1):
        if name == "bill_volatility":
            continue
        column = name if name in integers else r(name, name)
        out[f"c{i}_{name}"] = f(f"SELECT c_custkey, {column} FROM featured")
    out["c7_bill_volatility_sample"] = f(f"SELECT c_custkey, {r('bill_volatility', 'bill_volatility')} FROM featured")
    out["c7_bill_volatility_pop"] = f(f"SELECT c_custkey, {r('bill_volatility_pop', 'bill_volatility')} FROM featured")
    middle = "WHEN age > 25 AND age <= 35 THEN 1 WHEN age > 35 AND age <= 45 THEN 2 WHEN age > 45 AND age <= 55 THEN 3"
    for policy, first, last in (
        ("serving", "WHEN age >= 0 AND age <= 25 THEN 0", "ELSE 4"),
        ("training", "WHEN age > 0 AND age <= 25 THEN 0", "WHEN age > 55 AND age <= 100 THEN 4 ELSE 0"),
        ("scripts", "WHEN age > 0 AND age <= 25 THEN 0", "WHEN age > 55 AND age <= 100 THEN 4 ELSE 2"),
        ("r", "WHEN age <= 25 THEN 0", "ELSE 4"),
    ):
        out[f"c13_age_group_{policy}"] = over(
            "credit_profile", f"SELECT c_custkey, age, CASE {first} {middle} {last} END AS age_group FROM credit_profile")
    out["c14_summary_features"] = f(f"""
        SELECT c_custkey, months_delayed AS times_late, max_pay_delay AS max_months_late,
               {r('avg_bill_amt', 'avg_bill')}, {r('avg_pay_amt', 'avg_payment')},
               {r('avg_pay_amt / (abs(avg_bill_amt) + 1e0)', 'payment_ratio')}, {r('utilization_ratio', 'credit_util')}
        FROM featured""")
    everything = (*RAW, *ENGINEERED, *CATEGORIES)
    out["c15_feature_matrix"] = f(f"SELECT c_custkey, {rounded(everything)} FROM featured")

    def scaled(stats: str) -> str:
        return ", ".join(
            r(f"(d.{c} - {stats}.m_{c}) / {stats}.s_{c}", c) for c in (*RAW, *ENGINEERED)
        ) + ", " + ", ".join(f"d.{c}::DOUBLE AS {c}" for c in CATEGORIES)

    def stats(source: str) -> str:
        return "SELECT " + ", ".join(
            f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1e0 END AS s_{c}"
            for c in (*RAW, *ENGINEERED)) + f" FROM {source}"

    out["c16_standardised"] = over("featured", f"SELECT d.c_custkey, {scaled('s')} FROM featured d, s", {"s": stats("featured")})
    out["c17_train_test_matrices"] = over(
        ("featured", "split_profile"),
        f"SELECT d.split, d.c_custkey, d.is_default, {scaled('s')} FROM d, s",
        {"d": "SELECT f.*, split FROM featured f JOIN split_profile USING (c_custkey)",
         "s": stats("(SELECT * FROM d WHERE split = 'train')")})
    return out


def _velocity_statements() -> dict[str, str]:
    def frame(expression: str, interval: str, name: str) -> str:
        return f"""SELECT event_id, {expression} OVER (PARTITION BY user_id ORDER BY ts
            RANGE BETWEEN INTERVAL '{interval}' PRECEDING AND INTERVAL '1 microsecond' PRECEDING) AS {name} FROM events"""

    def amount(interval: str, name: str) -> str:
        inner = frame("sum(value)", interval, "total")
        return f"SELECT event_id, {r('coalesce(total, 0)', name, 4)} FROM ({inner})"

    return {
        "l1_tx_count_last_hour": frame("count(*)", "1 hour", "tx_count_last_hour"),
        "l2_tx_amount_last_hour": amount("1 hour", "tx_amount_last_hour"),
        "l3_tx_count_last_24h": frame("count(*)", "24 hours", "tx_count_last_24h"),
        "l4_tx_amount_last_24h": amount("24 hours", "tx_amount_last_24h"),
        "l5_unique_merchants_24h": frame("count(DISTINCT event_type)", "24 hours", "unique_merchants_24h"),
        "l6_avg_tx_amount": f"""SELECT event_id, {r('a', 'avg_tx_amount')} FROM (
            SELECT event_id, (sum(value::DECIMAL(20, 6)) OVER before)::DOUBLE / nullif(count(*) OVER before, 0) AS a FROM events
            WINDOW before AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
        "l7_failed_tx_last_hour": frame("count(*) FILTER (WHERE event_type = 'error')", "1 hour", "failed_tx_last_hour"),
        "l8_time_since_last_tx": """SELECT event_id, floor((epoch_us(ts) - epoch_us(lag(ts) OVER (
            PARTITION BY user_id ORDER BY ts, event_id))) / 1e6)::BIGINT AS time_since_last_tx FROM events""",
        "l9_account_age_days": """SELECT event_id, date_diff('day', min(ts) OVER (PARTITION BY user_id), ts) AS account_age_days
            FROM events""",
        "l10_calendar_fields": "SELECT event_id, hour(ts)::INTEGER AS hour_of_day, (isodow(ts) - 1)::INTEGER AS day_of_week FROM events",
    }


_LISTED = "[x FOR x IN [catboost, lightgbm, random_forest, xgboost] IF x IS NOT NULL]"


def _present(weights: dict[str, str]) -> tuple[str, str]:
    top = _plus(f"coalesce({m} * {w}, 0e0)" for m, w in weights.items())
    bottom = _plus(f"CASE WHEN {m} IS NULL THEN 0e0 ELSE {w} END" for m, w in weights.items())
    return top, bottom


def _scoring_statements() -> dict[str, str]:
    s = lambda body: over("scored", body)
    top, bottom = _present(WEIGHTS)
    mean = f"least(greatest(({top}) / ({bottom}), 0e0), 1e0)"
    equal_top, equal_bottom = _present({m: "1e0" for m in sorted(MODELS)})
    # The four-model table with one weight replaced and one removed, so that the default shows.
    changed = {"catboost": "0.1e0", "lightgbm": "0.25e0", "random_forest": "0.17e0", "xgboost": "0.50e0"}
    changed_top, changed_bottom = _present(changed)
    known = {m: WEIGHTS[m] for m in ("catboost", "random_forest", "xgboost")}
    known_top, known_bottom = _present(known)

    def one(expression: str, name: str) -> str:
        return s(f"SELECT c_custkey AS id, {r(expression, name)} FROM scored")

    listed_fill = "[" + ", ".join(f"coalesce({m}, 0.5e0)" for m in sorted(MODELS)) + "]"
    primary = over("predicted", f"""
        SELECT c_custkey AS id, {r('coalesce(lightgbm, risk_score)', 'risk_score')},
               CASE WHEN lightgbm IS NULL THEN 4 ELSE 1 END AS n_models,
               CASE WHEN lightgbm IS NOT NULL
                    THEN CASE WHEN lightgbm > 0.6e0 THEN printf('lightgbm:%.2f', lightgbm) ELSE '' END
                    ELSE {_TRIGGERED} END AS triggered FROM predicted""")
    return {
        "d3_logistic_scorecards": s(f"SELECT c_custkey AS id, {rounded(MODELS)} FROM scored"),
        "d4_normalised_from_map": one("CASE WHEN c_custkey % 3 = 2 THEN 0.5e0 ELSE xgboost END", "probability"),
        "d4_normalised_from_array": one("CASE WHEN c_custkey % 3 = 2 THEN 0.5e0 ELSE xgboost END", "probability"),
        "d5_weighted_mean": one(mean, "ensemble"),
        "d5_weighted_mean_long": one(mean, "ensemble"),
        "d6_equal_mean": one(f"({equal_top}) / ({equal_bottom})", "ensemble"),
        "d7_changed_weights": one(f"({changed_top}) / ({changed_bottom})", "ensemble"),
        "d8_gated_mean": one(f"CASE WHEN greatest({', '.join(MODELS)}) >= 0.5e0 THEN {mean} ELSE ({mean}) * 0.5e0 END", "ensemble"),
        "d9_max_score": one(f"greatest(0e0, list_max({_LISTED}))", "max_score"),
        "d10_min_score": one(f"least(1e0, list_min({_LISTED}))", "min_score"),
        "d11_median_score": one(f"list_median({_LISTED})", "median_score"),
        "d12_voting_score": one(f"len([x FOR x IN {_LISTED} IF x >= 0.5e0]) / len({_LISTED})::DOUBLE", "votes"),
        "d13_known_weight_mean": one(f"({known_top}) / ({known_bottom})", "ensemble"),
        "d14_plain_mean": one(f"({equal_top}) / ({equal_bottom})", "ensemble"),
        "d15_primary_strategy": primary,
        "d15_primary_absent": over("predicted", f"SELECT c_custkey AS id, {r('risk_score', 'risk_score')}, 0 AS n_models, '' AS triggered FROM predicted"),
        "d16_ensemble_strategy": over("predicted", f"SELECT c_custkey AS id, {r('risk_score', 'risk_score')}, 4 AS n_models, {_TRIGGERED} AS triggered FROM predicted"),
        "d17_threshold_lookup": over("model_scores", """
            SELECT model, threshold, count(*) FILTER (WHERE score >= threshold) AS n_over
            FROM (SELECT *, coalesce(CASE model WHEN 'xgboost' THEN 0.61e0 WHEN 'catboost' THEN 0.57e0
                                                WHEN 'random_forest' THEN 0.33e0 END, 0.61e0) AS threshold FROM model_scores)
            GROUP BY model, threshold"""),
        "d18_triggered": over("predicted", f"SELECT c_custkey AS id, {_TRIGGERED} AS triggered FROM predicted"),
        "d19_risk_level": over("levelled", "SELECT c_custkey AS id, risk_level FROM levelled"),
        "d20_build_alert": over("alerts", f"SELECT {_ALERT_COLUMNS} FROM alerts"),
        "d21_agreement": one(f"1e0 - least(list_stddev_pop({listed_fill}), 1e0)", "agreement"),
        "d22_anomaly_probability": over("featured", f"""
            SELECT c_custkey AS id, {r('1e0 - (raw - lo) / (hi - lo)', 'anomaly_score')} FROM (
              SELECT c_custkey, -utilization_ratio AS raw, min(-utilization_ratio) OVER () AS lo,
                     max(-utilization_ratio) OVER () AS hi FROM featured)"""),
        "d23_anomaly_flag": over("featured", """
            SELECT c_custkey AS id, (-utilization_ratio < (SELECT quantile_cont(-utilization_ratio, 0.1e0) FROM featured
                                     WHERE is_default = 0))::INTEGER AS is_anomaly FROM featured"""),
        "d24_scoring_job": over("alerts", f"SELECT {_ALERT_COLUMNS} FROM alerts WHERE c_custkey % 50 > 4"),
    }


def _latency(keys: str, names: dict[str, str], source: str = "timings") -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    pick = ", ".join(
        f"max(duration_us) FILTER (WHERE rn = floor(n * {p})::BIGINT) AS {name}" for name, p in names.items()
    )
    lead = f"{keys}, " if keys else ""
    return f"""
      SELECT {lead}count(*) AS calls, (sum(duration_us) // count(*))::BIGINT AS mean_us, {pick}, max(duration_us) AS max_us
      FROM (SELECT *, row_number() OVER ({part} ORDER BY duration_us) - 1 AS rn, count(*) OVER ({part}) AS n FROM {source})
      {group}"""


_RANKS = {"p50_us": "0.5e0", "p95_us": "0.95e0", "p99_us": "0.99e0"}


def _retained(cap: int) -> str:
    half = cap // 2
    return f"CASE WHEN n <= {cap} THEN n ELSE (n - {cap} - 1) % {half} + {half} + 1 END"


def _metric_statements() -> dict[str, str]:
    agreement = "1e0 - least(list_stddev_pop([" + ", ".join(f"coalesce({m}, 0.5e0)" for m in MODELS) + "]), 1e0)"
    volume = f"""
        SELECT count(*) AS processed, count(*) FILTER (WHERE risk_score >= 0.56e0) AS alerts,
               {r("100e0 * count(*) FILTER (WHERE risk_score >= 0.56e0) / count(*)", 'alert_rate')}"""
    rate = "count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6)"
    histogram = """
        SELECT b.bucket::INTEGER AS bucket, coalesce(n, 0) AS n, round(100e0 * coalesce(n, 0) / sum(n) OVER (), 6) AS pct
        FROM range(10) b(bucket) LEFT JOIN (SELECT least(floor(risk_score * 10e0), 9)::BIGINT AS bucket, count(*) AS n
                                            FROM predicted GROUP BY 1) c ON c.bucket = b.bucket"""
    return {
        "e1_alert_rate": over("predicted", f"{volume} FROM predicted"),
        "e2_latency": over("timings", _latency("", _RANKS)),
        "e3_latency_by_model": over("timings", _latency("model", _RANKS)),
        "e4_recent_history": over("timings", f"""
            SELECT event_id, model, duration_us FROM (
              SELECT *, row_number() OVER (PARTITION BY model ORDER BY ts DESC, event_id DESC) AS age,
                     count(*) OVER (PARTITION BY model) AS n FROM timings) WHERE age <= {_retained(1000)}"""),
        "e4_recent_history_all": over("timings", f"""
            SELECT event_id, duration_us FROM (
              SELECT *, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS age, count(*) OVER () AS n FROM timings)
            WHERE age <= {_retained(10000)}"""),
        "e5_average_agreement": over("scored", f"SELECT {r(f'avg({agreement})', 'avg_agreement')} FROM scored"),
        "e6_throughput": f"SELECT {r(rate, 'per_second')} FROM events",
        "e7_score_histogram": over("predicted", histogram),
        "e8_alerts_by_level": over("alerts", """
            SELECT risk_level, count(*) AS n, round(100e0 * count(*) / sum(count(*)) OVER (), 6) AS pct
            FROM alerts GROUP BY risk_level"""),
        "e9_pipeline_summary": over(("predicted", "timings"), f"""
            SELECT v.*, t.per_second, l.mean_us, l.p50_us, l.p95_us, l.p99_us, l.max_us, a.avg_agreement
            FROM ({volume} FROM predicted) v, (SELECT {r(rate, 'per_second')} FROM timings) t,
                 ({_latency("", _RANKS)}) l, (SELECT {r(f'avg({agreement})', 'avg_agreement')} FROM scored) a"""),
    }


def _evaluation_statements() -> dict[str, str]:
    counted = lambda t: f"SELECT model, {_COUNTS.format(t=t)} FROM long_scores GROUP BY model"
    e = lambda body: over("long_scores", body)
    f1 = f"({_PRECISION}) * (tp / nullif(p, 0)::DOUBLE) * 2e0 / (({_PRECISION}) + (tp / nullif(p, 0)::DOUBLE) + 1e-8)"
    f1 = f"coalesce({f1}, 0e0)"
    recall_at = "coalesce(tp / nullif(p, 0)::DOUBLE, 0e0)"

    def best(value: str) -> str:
        return on_curve(f"""
            SELECT model, {r('score', 'optimal_threshold')}, {r('v', 'best_score')} FROM (
              SELECT *, row_number() OVER (PARTITION BY model ORDER BY v DESC, score) AS rn
              FROM (SELECT *, {value} AS v FROM cumulative)) WHERE rn = 1""")

    def block(suffix: str) -> str:
        return ", ".join(
            r(x, f"{n}_{suffix}")
            for n, x in (("accuracy", _ACCURACY), ("precision", _PRECISION), ("recall", _RECALL), ("f1", _F1)))

    grid = {
        "grid": """
          SELECT model, k / 100e0 AS threshold, count(*) FILTER (WHERE score >= k / 100e0 AND label = 1) AS tp,
                 count(*) FILTER (WHERE score >= k / 100e0 AND label <> 1) AS fp,
                 count(*) FILTER (WHERE score < k / 100e0 AND label = 1) AS fn
          FROM long_scores, range(10, 91) g(k) GROUP BY model, k""",
    }
    negative = {
        "precision": "coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0e0)",
        "recall": "coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0e0)",
        "f1": "coalesce(2 * tn / nullif(2 * tn + fp + fn, 0)::DOUBLE, 0e0)",
    }
    positive = {"precision": _PRECISION, "recall": _RECALL, "f1": _F1}

    def report(name: str, values: dict[str, str], support: str) -> str:
        return f"""SELECT model, '{name}' AS "class", {', '.join(r(x, n) for n, x in values.items())},
                   ({support})::BIGINT AS support FROM c"""

    macro = {n: f"({negative[n]} + {positive[n]}) / 2e0" for n in positive}
    weighted = {n: f"({negative[n]} * (tn + fp) + {positive[n]} * (tp + fn)) / (tp + fp + tn + fn)" for n in positive}
    total = "tp + fp + tn + fn"
    classification = " UNION ALL ".join((
        report("0", negative, "tn + fp"), report("1", positive, "tp + fn"),
        report("accuracy", {n: _ACCURACY for n in positive}, total),
        report("macro avg", macro, total), report("weighted avg", weighted, total)))
    hit, real = "score >= 0.5e0", "label = 1"
    money = lambda cond: f"coalesce(sum(limit_bal) FILTER (WHERE {cond}), 0e0)"
    tuned = on_curve(f"""
        SELECT b.model, {r('score', 'optimal_threshold')}, {block('default').replace('tp', 'd.tp').replace('fp', 'd.fp').replace('tn', 'd.tn').replace('fn', 'd.fn')},
               {block('optimal').replace('tp', 'b.tp').replace('fp', 'b.fp').replace('tn', '(b.n - b.fp)').replace('fn', '(b.p - b.tp)')}
        FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY {f1} DESC, score) AS rn FROM cumulative) b
        JOIN ({counted('0.5e0')}) d ON d.model = b.model WHERE rn = 1""")
    alert_quality = f"""
        SELECT tp, fp, tn, fn, {r(_ACCURACY, 'accuracy')}, {r(_PRECISION, 'precision')}, {r(_RECALL, 'recall')}, {r(_F1, 'f1')}
        FROM (SELECT count(*) FILTER (WHERE risk_score >= 0.56e0 AND is_default = 1) AS tp,
                     count(*) FILTER (WHERE risk_score >= 0.56e0 AND is_default = 0) AS fp,
                     count(*) FILTER (WHERE risk_score < 0.56e0 AND is_default = 0) AS tn,
                     count(*) FILTER (WHERE risk_score < 0.56e0 AND is_default = 1) AS fn FROM predicted)"""
    alarm = {
        "fpr": "coalesce(fp / nullif(fp + tn, 0)::DOUBLE, 0e0)",
        "one_minus_precision": f"1e0 - {_PRECISION}",
        "one_minus_specificity": "1e0 - coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0e0)",
    }
    out = {
        "e10_confusion": e(counted("0.5e0")),
        "e11_evaluation": on_results(f"SELECT {_EVALUATION_COLUMNS} FROM evaluated"),
        "e12_roc_auc": on_curve(f"SELECT model, {r(_AUC, 'roc_auc')} FROM cumulative GROUP BY model"),
        "e12_roc_auc_ties": on_curve(f"SELECT model, {r(_AUC, 'roc_auc')} FROM cumulative GROUP BY model", "doc_scores"),
        "e13_average_precision": on_curve(f"SELECT model, {r(_AP, 'pr_auc')} FROM cumulative GROUP BY model"),
        "e13_average_precision_ties": on_curve(f"SELECT model, {r(_AP, 'pr_auc')} FROM cumulative GROUP BY model", "doc_scores"),
        "e14_precision_recall_curve": on_curve(f"SELECT model, {r('score', 'threshold', 8)}, {r(_PRECISION, 'precision', 8)}, {r(recall_at, 'recall', 8)} FROM cumulative"),
        "e15_roc_curve": on_curve(f"SELECT model, {r('score', 'threshold', 8)}, {r('coalesce(fp / nullif(n, 0)::DOUBLE, 0e0)', 'fpr', 8)}, {r(recall_at, 'tpr', 8)} FROM cumulative"),
        "e16_best_threshold_f1": best(f1),
        "e16_best_threshold_precision": best(_PRECISION),
        "e16_best_threshold_recall": best(recall_at),
        "e17_grid_threshold": over("long_scores", f"""
            SELECT model, CASE WHEN f1 > 0 THEN threshold ELSE 0.5e0 END AS optimal_threshold, {r('f1', 'best_score')} FROM (
              SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1 DESC, threshold) AS rn
              FROM (SELECT model, threshold, {_F1} AS f1 FROM grid)) WHERE rn = 1""", grid),
        "e19_default_and_optimal": tuned,
        "e20_classification_report": over("long_scores", classification, {"c": counted("0.5e0")}),
        "e21_business_metrics": e(f"""
            SELECT model, {r('t', 'total_fraud_amount', 2)}, {r('d', 'detected_fraud_amount', 2)}, {r('m', 'missed_fraud_amount', 2)},
                   {r('f', 'false_alarm_amount', 2)}, {r('coalesce(d / nullif(t, 0), 0e0)', 'fraud_amount_detection_rate')},
                   {r('coalesce(d / nullif(nd, 0), 0e0)', 'avg_detected_fraud_amount', 2)}, {r('coalesce(m / nullif(nm, 0), 0e0)', 'avg_missed_fraud_amount', 2)}
            FROM (SELECT model, {money(real)} AS t, {money(f"{real} AND {hit}")} AS d, {money(f"{real} AND NOT {hit}")} AS m,
                         {money(f"NOT {real} AND {hit}")} AS f, count(*) FILTER (WHERE {real} AND {hit}) AS nd,
                         count(*) FILTER (WHERE {real} AND NOT {hit}) AS nm FROM long_scores GROUP BY model)"""),
        "e22_alert_quality": over("predicted", alert_quality),
        "e23_alert_score_stats": over("alerts", f"""
            SELECT {r('min(s)', 'min_score')}, {r('max(s)', 'max_score')}, {r('avg(s)', 'mean_score')},
                   {r('max(s) FILTER (WHERE rn = n // 2)', 'median_score')}
            FROM (SELECT risk_score AS s, row_number() OVER (ORDER BY risk_score) - 1 AS rn, count(*) OVER () AS n FROM alerts)"""),
        "e24_class_distribution": over("split_profile", "SELECT split, is_default AS label, count(*) AS n FROM split_profile GROUP BY ALL"),
        "e25_dataset_stats": over("split_profile", f"SELECT split, count(*) AS n_rows, 36 AS n_features, {r('avg(is_default)', 'default_rate')} FROM split_profile GROUP BY split"),
    }
    for t, name in (("0.5e0", "default"), ("0.61e0", "configured")):
        out[f"e18_at_threshold_{name}"] = over("long_scores", f"""
            SELECT model, {t} AS threshold, {r(_ACCURACY, 'accuracy')}, {r(_PRECISION, 'precision')}, {r(_RECALL, 'recall')}, {r(_F1, 'f1')}
            FROM ({counted(t)})""")
    for name, expression in alarm.items():
        out[f"e26_false_alarm_{name}"] = over("long_scores", f"SELECT model, {r(expression, 'false_alarm_rate')} FROM ({counted('0.5e0')})")
    return out


_COMPARED = ("roc_auc", "f1", "precision", "recall", "accuracy")


def _long_metrics(source: str) -> str:
    return " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM {source}" for m in _COMPARED)


def _ranking_statements() -> dict[str, str]:
    rank = lambda m: (
        f"rank() OVER (ORDER BY {m} DESC) + (count(*) OVER (PARTITION BY {m}) - 1) / 2e0 AS rank_{m}")
    ranked = ("roc_auc", "f1", "precision", "recall")

    def versus(band: str) -> dict[str, str]:
        return {"versus": f"""
            SELECT metric, xgboost, catboost, xgboost - catboost AS difference,
                   CASE WHEN xgboost - catboost > {band} THEN 'xgboost' WHEN xgboost - catboost < -{band} THEN 'catboost'
                        ELSE 'tie' END AS winner
            FROM (SELECT metric, max(value) FILTER (WHERE model = 'xgboost') AS xgboost,
                         max(value) FILTER (WHERE model = 'catboost') AS catboost
                  FROM ({_long_metrics('evaluated')}) GROUP BY metric)"""}

    compared = f"SELECT metric, {rounded(('xgboost', 'catboost', 'difference'))}, winner FROM versus"
    top = f"""SELECT c_custkey::VARCHAR AS transaction_id, {r('risk_score', 'risk_score')}, risk_level FROM alerts
              WHERE is_default = {{label}} ORDER BY alerts.risk_score DESC, c_custkey LIMIT {{n}}"""
    ordered_scores = over("alerts", """
        SELECT c_custkey::VARCHAR AS transaction_id, string_agg(model, '>' ORDER BY score DESC, model) AS ordered_models
        FROM (""" + " UNION ALL ".join(
        f"SELECT c_custkey, '{m}' AS model, coalesce({m}, 0.5e0) AS score FROM alerts" for m in MODELS) + ") GROUP BY c_custkey")
    return {
        "f1_rank_models": on_results("SELECT model, " + r("roc_auc", "roc_auc") + ", row_number() OVER (ORDER BY evaluated.roc_auc DESC, model)::INTEGER AS rank FROM evaluated"),
        "f2_average_rank": on_results(f"""
            SELECT *, row_number() OVER (ORDER BY avg_rank, model)::INTEGER AS overall_rank
            FROM (SELECT *, ({_plus(f'rank_{m}' for m in ranked)}) / 4e0 AS avg_rank
                  FROM (SELECT model, {', '.join(rank(m) for m in ranked)} FROM singles))"""),
        "f3_best_single": on_results(f"SELECT model, {rounded(_COMPARED)} FROM singles ORDER BY singles.roc_auc DESC, model LIMIT 1"),
        "f5_top_correct_alerts": over("alerts", top.format(label=1, n=5)),
        "f6_top_false_alerts": over("alerts", top.format(label=0, n=3)),
        "f7_missed_positives": over("predicted", f"""
            SELECT c_custkey::VARCHAR AS transaction_id, pay_0, {r('limit_bal', 'limit_bal')} FROM predicted
            WHERE is_default = 1 AND risk_score < 0.56e0 ORDER BY c_custkey LIMIT 5"""),
        "f8_scores_in_order": ordered_scores,
        "f9_head_to_head": on_results(compared, versus("0e0")),
        "f9_head_to_head_band": on_results(compared, versus("0.001e0")),
        "f10_win_tally": on_results("""
            SELECT *, CASE WHEN first_wins > second_wins THEN 'xgboost' WHEN second_wins > first_wins THEN 'catboost'
                           ELSE 'tie' END AS overall_winner
            FROM (SELECT count(*) FILTER (WHERE winner = 'xgboost') AS first_wins,
                         count(*) FILTER (WHERE winner = 'catboost') AS second_wins,
                         count(*) FILTER (WHERE winner = 'tie') AS ties FROM versus)""", versus("0.001e0")),
        "f11_ensemble_improvement": on_results(f"""
            SELECT b.model AS best_model, {r('(e.roc_auc - b.roc_auc) / b.roc_auc * 100e0', 'roc_improvement')},
                   {r('(e.f1 - b.f1) / b.f1 * 100e0', 'f1_improvement')}
            FROM (SELECT * FROM singles ORDER BY roc_auc DESC, model LIMIT 1) b, evaluated e WHERE e.model = 'ensemble'"""),
    }


def _table_statements() -> dict[str, str]:
    scores = ", ".join(r(m, m) for m in MODELS)
    fold = """SELECT c_custkey, is_default, ((row_number() OVER (PARTITION BY is_default
              ORDER BY md5('{seed}' || c_custkey::VARCHAR), c_custkey) - 1) % {k})::INTEGER AS fold FROM credit_profile"""
    validation = """
        SELECT c_custkey, CASE WHEN rk <= floor(sz * 0.1e0) THEN 'validation' ELSE 'train' END AS split
        FROM (SELECT c_custkey, row_number() OVER ({part} ORDER BY md5('{seed}' || c_custkey::VARCHAR), c_custkey) AS rk,
                     count(*) OVER ({part}) AS sz FROM {source})"""
    scaled = ", ".join(
        r(f"({m} - min({m}) OVER ()) / nullif(max({m}) OVER () - min({m}) OVER (), 0)", m) for m in _COMPARED)
    return {
        "g1_labels_with_alerts": over("predicted", f"""
            SELECT c_custkey::VARCHAR AS transaction_id, is_default,
                   {r('CASE WHEN risk_score >= 0.56e0 THEN risk_score ELSE 0e0 END', 'predicted_score')},
                   risk_score >= 0.56e0 AS has_alert FROM predicted"""),
        "g2_right_alerts": over("alerts", "SELECT c_custkey::VARCHAR AS transaction_id, risk_level FROM alerts WHERE is_default = 1"),
        "g2_false_alerts": over("alerts", "SELECT c_custkey::VARCHAR AS transaction_id, risk_level FROM alerts WHERE is_default = 0"),
        "g3_labels_without_alert": over("predicted", "SELECT c_custkey::VARCHAR AS transaction_id FROM predicted WHERE is_default = 1 AND risk_score < 0.56e0"),
        "g4_parameter_lookup": over("model_scores", f"""
            SELECT id, model, {r("coalesce(CASE model WHEN 'xgboost' THEN 0.25e0 WHEN 'catboost' THEN 0.25e0 WHEN 'lightgbm' THEN 0.2e0 END, 0.1e0)", 'weight')}
            FROM model_scores"""),
        "g5_append_ensemble": over("predicted", " UNION ALL ".join(
            [f"SELECT c_custkey AS id, '{m}' AS model, {r(m, 'score')} FROM predicted" for m in MODELS]
            + [f"SELECT c_custkey, 'ensemble', {r('risk_score', 'score')} FROM predicted"])),
        "h1_metrics_long": on_results(f"SELECT model, metric, {r('value', 'value')} FROM ({_long_metrics('evaluated')})"),
        "h2_scores_wide": over("scored", f"SELECT c_custkey AS id, {scores} FROM scored"),
        "h3_score_maps": over("scored", "SELECT c_custkey AS id, concat_ws(',', " + ", ".join(
            f"CASE WHEN {m} IS NOT NULL THEN printf('{m}=%.4f', {m}) END" for m in sorted(MODELS)) + ") AS scores FROM scored"),
        "h3_exploded_maps": over("model_scores", f"SELECT id, model, {r('score', 'score')} FROM model_scores WHERE score IS NOT NULL"),
        "h4_min_max_metrics": on_results(f"SELECT model, {scaled} FROM singles"),
        "i1_stratified_split": over("split_profile", "SELECT c_custkey, is_default, split FROM split_profile"),
        "i2_validation_split": over("split_profile", validation.format(
            part="PARTITION BY is_default", seed="v", source="split_profile WHERE split = 'train'")),
        "i3_simple_validation_split": over("credit_profile", validation.format(part="", seed="", source="credit_profile")),
        "i4_stratified_folds": over("credit_profile", fold.format(seed="", k=3)),
        "j1_positive_weight": over("credit_profile", f"""
            SELECT is_default AS label, count(*) AS n, {r("CASE WHEN is_default = 1 THEN (SELECT count(*) FILTER (WHERE is_default = 0) / count(*) FILTER (WHERE is_default = 1)::DOUBLE FROM credit_profile) ELSE 1e0 END", 'weight')}
            FROM credit_profile GROUP BY is_default"""),
        "j2_balanced_weights": over("credit_profile", f"""
            SELECT is_default AS label, count(*) AS n, {r("(SELECT count(*) FROM credit_profile) / (2e0 * count(*))", 'weight')}
            FROM credit_profile GROUP BY is_default"""),
    }


def _stream_statements() -> dict[str, str]:
    scoring = _scoring_statements()
    windows = f"""
        SELECT (epoch_us(time_bucket(INTERVAL '30 seconds', ts)) // 1000000)::BIGINT AS window_second, count(*) AS processed,
               count(*) FILTER (WHERE value / 500e0 >= 0.56e0) AS alerts, {r('avg(value / 500e0)', 'mean_score')}
        FROM events GROUP BY 1"""
    good = "predicted WHERE c_custkey % 50 > 4"
    growth = "(1.01e0 / 0.99e0)"
    # Where an exact percentile lies among cells that grow by that factor.
    near = lambda x: f"CASE WHEN {x} < 1 THEN 0e0 ELSE 2e0 * pow({growth}, 1 + floor(ln({x}) / ln({growth}))) / ({growth} + 1) END"
    picked = lambda us, part: ", ".join(
        f"max({us}) FILTER (WHERE rank_{us} = floor(n_{us} * {p})::BIGINT) AS {part}{name}" for name, p in _RANKS.items())
    ranked = lambda us, keys: f"row_number() OVER (PARTITION BY {keys} ORDER BY {us}) - 1 AS rank_{us}, count(*) OVER (PARTITION BY {keys}) AS n_{us}"
    level = lambda low, high: f"count(*) FILTER (WHERE score >= 0.56e0 AND score >= {low} AND score < {high})"
    tenths = " || ',' || ".join(f"count(*) FILTER (WHERE least(floor(score * 10e0), 9) = {b})" for b in range(10))
    report = f"""
        WITH timed AS (
          SELECT epoch_us(time_bucket(INTERVAL '30 seconds', ts)) // 1000000 AS w, value / 500e0 AS score, floor(value * 100e0)::BIGINT AS us,
                 event_type AS model, floor(value * 40e0)::BIGINT AS mus, 1e0 - value / 1000e0 AS agreement FROM events),
        ordered AS (SELECT *, {ranked('us', 'w')}, {ranked('mus', 'w, model')} FROM timed),
        whole AS (
          SELECT w, count(*) AS processed, count(*) FILTER (WHERE score >= 0.56e0) AS alerts, (sum(us) // count(*))::BIGINT AS mean_us,
                 {picked('us', '')}, max(us) AS max_us, avg(agreement) AS agreement, {level('-1e9', '0.5e0')} AS level_low,
                 {level('0.5e0', '0.7e0')} AS level_medium, {level('0.7e0', '0.9e0')} AS level_high, {level('0.9e0', '1e9')} AS level_critical,
                 {tenths} AS score_buckets FROM ordered GROUP BY w),
        by_model AS (SELECT w, model, count(*) AS calls, (sum(mus) // count(*))::BIGINT AS mean_us, {picked('mus', '')} FROM ordered GROUP BY w, model),
        listed AS (
          SELECT w, string_agg(printf('%s %d %d %.3f %.3f %.3f', model, calls, mean_us, {", ".join(near(n) for n in _RANKS)}), '; ' ORDER BY model) AS models
          FROM by_model GROUP BY w)
        SELECT w::BIGINT AS window_second, processed, alerts, {r('100e0 * alerts / processed', 'alert_rate')}, {r('processed / 30e0', 'per_second')},
               mean_us, {", ".join(r(near(n), n) for n in _RANKS)}, max_us, {r('agreement', 'avg_agreement')},
               level_low, level_medium, level_high, level_critical, score_buckets, models
        FROM whole JOIN listed USING (w)"""
    metric, tables = _metric_statements(), _table_statements()
    history = metric["e4_recent_history"]
    velocity = list(_velocity_statements().values())[:9]
    return {
        "k1_scoring_stream": scoring["d24_scoring_job"],
        "k2_reject_stream": _source_statements()["a4_decode_rejected"],
        "k3_running_totals": over("levelled", f"""
            SELECT risk_level, least(floor(risk_score * 10e0), 9)::INTEGER AS bucket, count(*) AS processed,
                   count(*) FILTER (WHERE risk_score >= 0.56e0) AS alerts FROM {good.replace('predicted', 'levelled')} GROUP BY ALL"""),
        "k4_report_windows": windows,
        "k4_report_windows_stream": windows,
        "k4_full_report": report,
        "k4_full_report_stream": report,
        "e4_recent_history_stream": history,
        "e22_alert_quality_stream": _evaluation_statements()["e22_alert_quality"],
        **{f"{n}_stream": tables[n] for n in tables if n.startswith(("g1_", "g2_", "g3_"))},
        "e3_recent_latency_stream": f"""
            SELECT s.*, p.pushed FROM ({_latency("model", _RANKS, f"({history})")}) s
            JOIN (SELECT event_type AS model, count(*) AS pushed FROM events GROUP BY 1) p USING (model)""",
        "k5_progress": over("predicted", f"SELECT count(*) AS processed FROM {good}"),
        "k6_restarted_stream": scoring["d24_scoring_job"],
        "l_stream_velocity": f"SELECT * FROM ({velocity[0]})" + "".join(f" JOIN ({v}) USING (event_id)" for v in velocity[1:]),
        "k6_published_alerts": scoring["d24_scoring_job"],
        "k7_paced_table": "SELECT count(*) AS n, count(DISTINCT c_custkey) AS n_distinct FROM customer",
        "k7_replayed_table": "SELECT count(*) AS n, count(DISTINCT c_custkey) AS n_distinct FROM customer",
    }


def _learning_statements() -> dict[str, str]:
    """What must hold of learned models whichever way they were grown."""
    fitted = lambda name: over("credit_profile", f"SELECT '{name}' AS model, count(*) AS n_rows, count(*) AS n_valid, true AS learned FROM credit_profile")
    slots = ", ".join(f"('{m}')" for m in MODELS)
    validation = _table_statements()["i2_validation_split"]
    train = "(SELECT count(*) FROM split_profile WHERE split = 'train')"
    test = "(SELECT count(*) FROM split_profile WHERE split = 'test')"
    every = "'catboost,isolation_forest,lightgbm,random_forest,xgboost' AS models, '1,2,3,4,5' AS ranks, true AS by_auc"
    return {
        "d1_score_with_model": fitted("xgboost"),
        "d2_score_batch": over("credit_profile", "SELECT count(*) AS n, count(*) AS n_xgboost, count(*) AS n_random_forest FROM credit_profile"),
        "f4_top_importances": "SELECT 20::BIGINT AS n, 16::BIGINT AS n_left, true AS none_higher, true AS are_shares",
        "j3_boosted_xgboost": fitted("xgboost"),
        "j3_boosted_lightgbm": fitted("lightgbm"),
        "j3_boosted_catboost": fitted("catboost"),
        "j4_early_stopping": over("split_profile", f"SELECT {train} AS n_rows, 40 AS rounds_asked, true AS stopped_early"),
        "j4_staged_stopping": f"""
            WITH rows_ AS ({validation})
            SELECT count(*) FILTER (WHERE split = 'validation') AS n_rows, 200 AS rounds_asked, true AS best_before_last,
                   true AS ended_early, true AS cut_equals_stage FROM rows_""",
        "j5_random_forest": fitted("random_forest"),
        "j6_isolation_forest": over("credit_profile", """
            SELECT count(*) AS n, count(*) AS n_valid, 0e0 AS lowest, 1e0 AS highest, true AS late_payers_stand_out FROM credit_profile"""),
        "j7_random_search": "SELECT 'random_forest' AS model, trial::INTEGER AS trial, 2 AS n_params, true AS valid FROM (VALUES (0), (1)) AS t(trial)",
        "j7_penalised_leaves": "SELECT 'catboost' AS model, p AS l2_leaf_reg, true AS valid, true AS refitted FROM (VALUES ('1'), ('7')) AS t(p)",
        "j8_best_parameters": "SELECT 'xgboost' AS model, 2::BIGINT AS n_trials, true AS is_highest",
        "j9_validation_auc": f"""
            WITH rows_ AS ({validation})
            SELECT model, (SELECT count(*) FROM rows_ WHERE split = 'validation') AS n_rows, true AS valid FROM (VALUES {slots}) AS t(model)""",
        "j10_model_comparison": f"SELECT {every}",
        "j11_importances": f"""
            SELECT model, 36::BIGINT AS n, 36::BIGINT AS n_known, 36::BIGINT AS n_not_negative, 1e0 AS total
            FROM (VALUES ('random_forest'), ('uniform')) AS t(model)""",
        "j12_save_load": over("credit_profile", "SELECT count(*) AS n, count(*) AS same_catboost, count(*) AS same_random_forest FROM credit_profile"),
        "j13_training_job": over("split_profile", f"SELECT {every}, {train} AS train_samples, {test} AS test_samples"),
        "j13_tuned_job": over("split_profile", f"""
            SELECT 'random_forest,xgboost' AS models, '1,2' AS ranks, true AS by_auc, 2::BIGINT AS n_iter, 2::BIGINT AS cv_folds,
                   {train} AS train_samples, true AS names_parameters, 4::BIGINT AS n_trials, 2::BIGINT AS n_thresholds"""),
    }


def statements() -> dict[str, str]:
    """Statement per query name. Queries without one have no SQL form."""
    out: dict[str, str] = {}
    for part in (
        _source_statements, _cleaning_statements, _feature_statements, _velocity_statements, _scoring_statements,
        _metric_statements, _evaluation_statements, _ranking_statements, _table_statements, _stream_statements,
        _learning_statements,
    ):
        out |= part()
    return out
