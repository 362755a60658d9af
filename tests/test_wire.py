"""Strict decoding of transaction messages."""

import json
import random

import pytest
from pyspark.sql import functions as F

from riskloom.sources import tables, wire
from test_scoring import base_row


def message(**changes):
    row = {"transaction_id": "tx_1", **base_row()} | changes
    return {k: v for k, v in row.items() if v != "absent"}


def decode(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return {r["value"]: r for r in wire.decode_transactions(df).collect()}


def reason(spark, text):
    return decode(spark, text)[text]["reject_reason"]


GOOD = {
    "plain": json.dumps(message()),
    "aliases": json.dumps({wire.FIELD_ALIASES[k]: v for k, v in message().items()}),
    "whole numbers as doubles": json.dumps(message(limit_bal=50000)),
    "exponent": json.dumps(message()).replace("50000.0", "5e4"),
    "unknown field": json.dumps(message(extra=[1, 2, {"a": "]"}])),
    "spaces": "  " + json.dumps(message()) + "\n",
    "time": json.dumps(message(timestamp="2025-01-02T03:04:05.678Z")),
    "time with offset": json.dumps(message(timestamp="2025-01-02T03:04:05+02:00")),
    "bracket in text": json.dumps(message(transaction_id="a]b")),
}
BAD = {
    "malformed": [
        "",
        "nope",
        "[1]",
        '"text"',
        json.dumps(message())[:-5],
        json.dumps(message()) + " x",
        json.dumps(message()) + json.dumps(message()),
        json.dumps(message()) + "] {}",
        json.dumps(message()) + ',{"a":1}',
        json.dumps(message()).replace('"age"', '"age": 1, "age"'),
    ],
    "age": [
        json.dumps(message(age="35")),
        json.dumps(message(age=35.0)),
        json.dumps(message(age=None)),
        json.dumps(message(age=3_000_000_000)),
        json.dumps(message(age="absent")),
        json.dumps(message(AGE=35)),
    ],
    "limit_bal": [json.dumps(message(limit_bal="5")), json.dumps(message()).replace("50000.0", "1e999")],
    "transaction_id": [json.dumps(message(transaction_id=7)), json.dumps(message(transaction_id="absent")), "{}"],
    "timestamp": [
        json.dumps(message(timestamp=None)),
        json.dumps(message(timestamp="yesterday")),
        json.dumps(message(timestamp="2025-13-02T03:04:05Z")),
        json.dumps(message(timestamp="2025-01-02")),
    ],
}


def test_accepts(spark):
    rows = decode(spark, *GOOD.values())
    assert {k: rows[t]["reject_reason"] for k, t in GOOD.items()} == dict.fromkeys(GOOD)
    assert all(rows[t]["limit_bal"] == 50000.0 and rows[t]["age"] == 35 for t in GOOD.values())
    assert all(rows[t]["timestamp"] is not None for t in GOOD.values())
    assert str(rows[GOOD["time with offset"]]["timestamp"]) == "2025-01-02 01:04:05"


@pytest.mark.parametrize("expected", BAD)
def test_rejects(spark, expected):
    rows = decode(spark, *BAD[expected])
    assert {t: r["reject_reason"] for t, r in rows.items()} == dict.fromkeys(BAD[expected], expected)


def test_split_is_complete(spark):
    texts = [*GOOD.values(), *[t for group in BAD.values() for t in group]]
    decoded = wire.decode_transactions(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert wire.accepted(decoded).count() == len(GOOD)
    assert wire.rejected(decoded).count() == len(texts) - len(GOOD)


def test_round_trip(spark):
    sent = decode(spark, GOOD["plain"])[GOOD["plain"]].asDict()
    row = {n: sent[n] for n in wire.FIELD_ALIASES} | {"ID": 12}
    again = spark.createDataFrame([row]).select(
        wire.to_transaction_json("ID", F.lit("2025-01-02T03:04:05Z")).alias("value")
    )
    row = wire.decode_transactions(again).first()
    assert row["reject_reason"] is None and row["transaction_id"] == "12"
    assert all(row[n] == sent[n] for n in (*wire.INTEGER_FIELDS, *wire.DOUBLE_FIELDS))


def alert(number, score, level):
    return {
        "alert_id": f"a{number}", "transaction_id": str(number), "risk_score": score, "risk_level": level,
        "model_scores": {"xgboost": score}, "triggered_features": ["xgboost:0.90"],
        "timestamp": "2025-01-02T03:04:05Z", "credit_limit": 1.0, "customer_info": "age_3", "context": "edu_1",
    }


def test_newest_alert_array_file(spark, tmp_path):
    (tmp_path / "alerts_20250101_000000.json").write_text(json.dumps([alert(1, 0.6, "medium")]))
    (tmp_path / "alerts_20250102_000000.json").write_text(
        json.dumps([alert(2, 0.95, "critical"), alert(3, 0.7, "high")], indent=2)
    )
    (tmp_path / "other_20260101.json").write_text("[]")
    rows = {r["transaction_id"]: r for r in tables.read_latest_alerts(spark, str(tmp_path)).collect()}
    assert set(rows) == {"2", "3"} and rows["2"]["model_scores"] == {"xgboost": 0.95}


def test_no_alert_files(spark, tmp_path):
    (tmp_path / "readme.txt").write_text("x")
    assert tables.read_latest_alerts(spark, str(tmp_path)).count() == 0


def test_alert_json_fields(spark, sf_dir):
    from riskloom.plans import fixtures
    from riskloom.plans.scoring import ALERT_FIELDS

    row = wire.to_alert_json(fixtures.alerts(spark, sf_dir)).first()
    parsed = json.loads(row["value"])
    assert list(parsed) == list(ALERT_FIELDS) and parsed["transaction_id"] == row["key"]
    assert parsed["risk_level"] in ("medium", "high", "critical")


def mutated_messages(n=500):
    """Messages with faults of all kinds, in both spellings and several ways to write them."""
    rng = random.Random(21)
    odd = ["x", "30", "NaN", 30.0, 3e400, True, None, {"a": 1}, [1], -5, 2**40, 1e300, "", '"', "\\", "é", 0.1]
    out = []
    for i in range(n):
        upper = rng.random() < 0.5
        pairs = []
        for name, alias in wire.FIELD_ALIASES.items():
            value = str(i) if name == "transaction_id" else rng.randrange(9) if name in wire.INTEGER_FIELDS else rng.choice([1, 2.5, 1e3, 123.456789012345])
            pairs.append([alias if upper else name, value])
        if rng.random() < 0.5:
            pairs.append(["timestamp", rng.choice(["2024-01-01T00:00:00Z", "2024-01-01 10:00:00.25+01:00"])])
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            at = rng.randrange(len(pairs))
            kind = rng.randrange(9)
            if kind == 0:
                pairs[at][1] = rng.choice(odd)
            elif kind == 1:
                pairs.pop(at)
            elif kind == 2:
                pairs.insert(rng.randrange(len(pairs)), list(pairs[at]))
            elif kind == 3:
                pairs[at][0] = pairs[at][0].swapcase()
            elif kind == 4:
                pairs.append(["more", rng.choice(odd)])
            elif kind == 5:
                pairs += [["more", 1], ["more", 2]]
            elif kind == 6:
                pairs.append(["timestamp", rng.choice(["2024-01-01", "2024-13-01T00:00:00Z", 5, None, "2024-01-01T00:00:00Z"])])
            elif kind == 7:
                pairs.append(["limit_bal" if upper else "LIMIT_BAL", 1.0])
            else:
                rng.shuffle(pairs)
        comma, colon = rng.choice([(",", ":"), (", ", ": "), (" ,\n", " : ")])
        text = "{" + comma.join(json.dumps(k) + colon + json.dumps(v, ensure_ascii=rng.random() < 0.5) for k, v in pairs) + "}"
        edit = rng.random()
        if edit < 0.05:
            text = text[: rng.randrange(len(text))]
        elif edit < 0.1:
            text += rng.choice([" ", "\n", "x", "{}", "]", ",", "}"])
        elif edit < 0.13:
            text = rng.choice([" ", "[", "x"]) + text
        elif edit < 0.16:
            text = text.replace(":", ":0", 1) if rng.random() < 0.5 else text.replace("}", ",}")
        out.append(text)
    return out + [None, "", "{}", "[]", "null", "{", '{"a":1}', '"x"']


def test_quick_verdicts_equal_the_long_way(spark, monkeypatch):
    messages = spark.createDataFrame([(i, m) for i, m in enumerate(mutated_messages())], "n int, value string").persist()
    quick = {r["n"]: r for r in wire.decode_transactions(messages).collect()}
    sure = wire._once(wire._once(messages, "_fast", wire._typed_parse(F.col("value"))), "_verdict", wire._verdict(F.col("value"), "_fast"))
    judged = {r["n"]: r["_verdict"]["sure"] for r in sure.collect()}
    unsure = F.struct(F.lit(False).alias("sure"), F.lit(None).cast("string").alias("fault"))
    monkeypatch.setattr(wire, "_verdict", lambda text, fast: unsure)
    slow = {r["n"]: r for r in wire.decode_transactions(messages).collect()}
    assert quick.keys() == slow.keys()
    for n, row in slow.items():
        assert quick[n]["reject_reason"] == row["reject_reason"], row["value"]
        if row["reject_reason"] is None and row["value"].count("timestamp"):
            assert quick[n] == row
        elif row["reject_reason"] is None:
            assert quick[n].asDict() | {"timestamp": 0} == row.asDict() | {"timestamp": 0}
    accepted = [n for n, r in slow.items() if r["reject_reason"] is None]
    assert len(accepted) > 100 and sum(judged[n] for n in accepted) > 0.5 * len(accepted)
    assert sum(judged[n] for n in judged if n not in accepted) > 20
