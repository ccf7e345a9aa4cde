import json

import pytest
from pyspark.sql import functions as F

from tickloom.operators import validate as va
from tickloom.params import Params
from tickloom.schemas import RAW_TRADE
from tickloom.sources.topic import decode_topic, encode_topic
from tickloom.operators.quality import observed
from tickloom.sources.wire import parse_wire, read_wire, wire_trades

GOOD = {"e": "aggTrade", "E": 5, "s": "BTCUSDT", "a": 7, "p": "1.5", "q": "2", "T": 1500, "m": True}


def message(stream="btcusdt@aggTrade", **changes):
    data = {k: v for k, v in {**GOOD, **changes}.items() if v is not ...}
    body = {"data": data}
    if stream is not ...:
        body["stream"] = stream
    return json.dumps(body)


CASES = [
    (message(), "ok"),
    (message(s=" btcusdt\t\n"), "ok"),
    (message(a="7", T="1500"), "ok"),
    (message(a=7.0), "ok"),
    (message(m="yes"), "ok"),
    (message(m=1), "ok"),
    (message(p="1e3"), "ok"),
    (message(p=" 1.5 "), "ok"),
    (message(extra=1), "ok"),
    (message(stream=...), "ignored"),
    ("[1, 2]", "ignored"),
    ('"text"', "ignored"),
    ("{}", "ignored"),
    (message(e="trade"), "ignored"),
    (message(e="trade", p=...), "parse_error"),
    (message(stream=5), "parse_error"),
    (message(p=1.5), "parse_error"),
    (message(q=2), "parse_error"),
    (message(s=5), "parse_error"),
    (message(s=None), "parse_error"),
    (message(a=7.5), "parse_error"),
    (message(a="x"), "parse_error"),
    (message(T=...), "parse_error"),
    (message(m="maybe"), "parse_error"),
    (message(m=2), "parse_error"),
    (message(p="abc"), "parse_error"),
    (message(p="1.5d"), "parse_error"),
    (message(p=""), "parse_error"),
    (message(p="0"), "parse_error"),
    (message(p="-1"), "parse_error"),
    (message(q="nan"), "parse_error"),
    ("{cut", "parse_error"),
    ("", "parse_error"),
    ("12", "parse_error"),
    ("null", "parse_error"),
    ('{"stream":"x"}', "parse_error"),
    ('{"stream":"x","data":[]}', "parse_error"),
]


def test_wire_status(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, value string")
    got = {r.i: r for r in parse_wire(df).collect()}
    wrong = [(CASES[i], got[i].status) for i in got if got[i].status != CASES[i][1]]
    assert not wrong
    first = got[1]
    assert (first.symbol, first.price, first.quantity, first.trade_id) == ("BTCUSDT", 1.5, 2.0, 7)
    assert spark.createDataFrame([(first.event_time,)], "t timestamp").select(
        F.unix_millis("t")
    ).first()[0] == 1500
    assert got[9].symbol is None and got[9].raw == CASES[9][0]


def test_topic_round_trip(spark):
    params = Params()
    rows = spark.sql(
        """SELECT * FROM VALUES
        ('BTCUSDT', 1.25D, 3.0D, TIMESTAMP'2024-01-01 00:00:00.123456', 1L),
        ('ETHUSDT', 0.1D, 1e-7D, TIMESTAMP'2024-01-01 00:00:00', 2L),
        ('DOGEUSDT', 0.1D, 1.0D, TIMESTAMP'2024-01-01 00:00:00', 3L)
        AS t(symbol, price, quantity, event_time, trade_id)"""
    )
    sent = encode_topic(rows, params)
    values = {r.key: r for r in sent.collect()}
    assert set(values) == {"BTCUSDT", "ETHUSDT"}
    assert values["BTCUSDT"].partition == 0 and values["ETHUSDT"].partition == 1
    assert json.loads(values["BTCUSDT"].value)["event_time"] == "2024-01-01T00:00:00.123456+00:00"
    assert json.loads(values["ETHUSDT"].value)["event_time"] == "2024-01-01T00:00:00+00:00"
    back = decode_topic(sent).where("status = 'ok'").select(*rows.columns)
    assert back.exceptAll(rows.where("trade_id < 3")).count() == 0
    assert back.count() == 2


@pytest.mark.parametrize(
    "change,status",
    [
        ({}, "ok"),
        ({"event_time": "2024-01-01T02:00:00+02:00"}, "ok"),
        ({"event_time": "2024-01-01T00:00:00"}, "ok"),
        ({"event_time": "2024-01-01"}, "ok"),
        ({"price": "1.5"}, "ok"),
        ({"trade_id": "12"}, "ok"),
        ({"event_time": "yesterday"}, "failed"),
        ({"event_time": "2024"}, "failed"),
        ({"price": 0}, "failed"),
        ({"quantity": -1}, "failed"),
        ({"symbol": 5}, "failed"),
        ({"trade_id": 1.5}, "failed"),
        ({"trade_id": None}, "failed"),
    ],
)
def test_topic_decoding(spark, change, status):
    body = {
        "symbol": "btcusdt ",
        "price": 1.5,
        "quantity": 2,
        "event_time": "2024-01-01T00:00:00Z",
        "trade_id": 3,
        **change,
    }
    df = spark.createDataFrame([(json.dumps(body),)], "value string")
    row = decode_topic(df).withColumn("us", F.unix_micros("event_time")).first()
    assert row.status == status
    if status == "ok":
        assert row.symbol == "BTCUSDT"
        assert row.us == 1704067200 * 1_000_000


def test_topic_garbage(spark):
    df = spark.createDataFrame([("{",), ("[]",), ("",), (None,), ("7",)], "value string")
    assert {r.status for r in decode_topic(df).collect()} == {"failed"}


def test_validation_faults(spark):
    nan = float("nan")
    rows = [
        ("a ", 1.0, 1.0, None, 1),
        ("a", 0.0, 1.0, None, 2),
        ("a", nan, 1.0, None, 3),
        ("a", 1.0, -0.5, None, 4),
        (None, 1.0, 1.0, None, 5),
    ]
    df = spark.createDataFrame(rows, RAW_TRADE).withColumn(
        "event_time", F.when(F.col("trade_id") != 5, F.timestamp_micros(F.lit(1)))
    )
    got = {r.trade_id: (r.symbol, r.fault) for r in va.validate_trades(df).collect()}
    assert got == {
        1: ("A", None),
        2: ("A", "price_not_positive"),
        3: ("A", "price_not_positive"),
        4: ("A", "quantity_not_positive"),
        5: (None, "missing_field"),
    }
    assert va.good_trades(df).count() == 1 and va.bad_trades(df).count() == 4


def test_counts_pass_with_the_rows(spark, tmp_path):
    texts = [message(), message(), message(e="trade"), "{cut"]
    path = str(tmp_path / "wire")
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(path)
    rows, watch = observed(parse_wire(read_wire(spark, path)), "ingest")
    assert len(rows.collect()) == 4
    assert watch.get == {"received": 4, "ok": 2, "ignored": 1, "parse_error": 1}
    assert wire_trades(read_wire(spark, path)).count() == 2
