import base64

from pyspark.sql import functions as F

from clickweave.sources import decode
from tests.conftest import ev, lines_df, session


def reasons(spark, lines):
    p = decode.parse_sessions(lines_df(spark, lines))
    return [r.reject_reason for r in p.orderBy("source").collect()]


def test_bad_json_variants(spark):
    bad = ["", "not json", "[1]", "5", "{'a':1}", '{"session_id":"c"} trailing', '{"session_id":"b","events":"str"}']
    assert reasons(spark, bad) == ["bad_json"] * len(bad)


def test_json_white_space_and_text_after_the_object(spark):
    one = '{"session_id":"a","user_id":"}{ ]"}'
    good = [one, f"\n{one}", f"{one}\n", f" \t\r\n{one}\r\n\t "]
    assert reasons(spark, good) == [None] * len(good)
    bad = [f"{one} {one}", f"{one}{one}", f"{one},{one}", f"{one} x}}", f"{one}}}", f"{one}]", f"\xa0{one}", f"\x0b{one}"]
    assert reasons(spark, bad) == ["bad_json"] * len(bad)


def test_missing_session_id(spark):
    rows = [{"user_id": "u"}, {"session_id": None}, {"session_id": ""}]
    assert reasons(spark, rows) == ["missing_session_id"] * 3


def test_good_record_and_duplicate_key_last_wins(spark):
    rows = [session("A", [ev()]), '{"session_id":"d","session_id":"e"}']
    p = decode.parse_sessions(lines_df(spark, rows)).orderBy("source").collect()
    assert [r.reject_reason for r in p] == [None, None]
    assert p[1].rec.session_id == "e"


def test_message_decoding_reasons(spark):
    df = spark.createDataFrame(
        [("m1", b""), ("m2", b"\xff\xfe"), ("m3", None), ("m4", b'{"session_id":"S"}')],
        "message_id string, data binary",
    ).withColumn("publish_time", F.current_timestamp())
    got = {r.message_id: r.reject_reason for r in decode.parse_messages(df).collect()}
    assert got == {"m1": "empty_message", "m2": "bad_encoding", "m3": "empty_message", "m4": None}


def test_push_envelopes(spark):
    good = base64.b64encode(b'{"session_id":"S1","events":[]}').decode()
    bodies = [
        ("a", '{"message":{"data":"%s","messageId":"1","publishTime":"2024-07-01T10:00:00Z"}}' % good),
        ("b", '{"nomessage":1}'),
        ("c", '{"message":{"messageId":"3"}}'),
        ("d", '{"message":{"data":"!!!","messageId":"4"}}'),
    ]
    df = spark.createDataFrame(bodies, "k string, body string")
    out = decode.decode_push_envelopes(df).collect()
    got = sorted(((r.message_id, r.reject_reason) for r in out), key=lambda t: (t[0] or "", t[1] or ""))
    assert got == [(None, "bad_envelope"), ("1", None), ("3", "empty_message"), ("4", "bad_encoding")]
    first = [r for r in out if r.message_id == "1"][0]
    assert first.rec.session_id == "S1"
    assert str(first.publish_time) == "2024-07-01 10:00:00"


def test_read_jsonl_glob(spark, scratch):
    import os

    with open(os.path.join(scratch, "a.jsonl"), "w") as f:
        f.write('{"session_id":"A"}\n{"session_id":"B"}\n')
    with open(os.path.join(scratch, "skip.txt"), "w") as f:
        f.write('{"session_id":"C"}\n')
    df = decode.read_jsonl(spark, scratch)
    rows = df.collect()
    assert len(rows) == 2
    assert all(r.source.endswith("a.jsonl") for r in rows)
