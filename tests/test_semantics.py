"""Handmade batches: parsing, validation and the rate rule at its edges."""

import datetime as dt

from surgeflow.config import DetectorConfig
from surgeflow.operators.detect import batch_metrics, batch_span, ip_rate, split_events
from surgeflow.sources.messages import encode_messages, parse_events, validate_events
from tests.helpers import DEFAULT, batch, msg, spread, with_batch


def _rates(spark, texts, cfg=DEFAULT):
    valid, _ = validate_events(batch(spark, texts, keep_raw=False))
    ev = with_batch(valid)
    return ev, ip_rate(ev, cfg)


def _flagged_ips(rates):
    return {r["ip_address"] for r in rates.filter("is_bot").collect()}


# --- parsing (M1-M7) -------------------------------------------------------

def test_m1_good_message_keeps_microseconds(spark):
    row = batch(spark, [msg(1, "10.1.0.1")]).first()
    assert row["event_ts"] == dt.datetime(2026, 6, 18, 10, 0, 0)
    t = '{"event_id":"a","user_id":"u","action":"VIEW","product_id":"PRD-0001",' \
        '"timestamp":"2026-06-18T10:15:30.123456+00:00","ip_address":"1.2.3.4"}'
    assert batch(spark, [t]).first()["event_ts"] == dt.datetime(2026, 6, 18, 10, 15, 30, 123456)


def test_m2_other_offset_converted_to_utc(spark):
    t = msg(1, "1.2.3.4").replace("2026-06-18T10:00:00.000000+00:00", "2026-06-18T10:15:30+03:00")
    assert batch(spark, [t]).first()["event_ts"] == dt.datetime(2026, 6, 18, 7, 15, 30)


def test_m3_no_offset_read_as_utc(spark):
    t = msg(1, "1.2.3.4").replace("2026-06-18T10:00:00.000000+00:00", "2026-06-18T10:15:30")
    assert batch(spark, [t]).first()["event_ts"] == dt.datetime(2026, 6, 18, 10, 15, 30)


def test_m4_malformed_and_null_go_to_dead_letter(spark):
    df = parse_events(spark.createDataFrame([("not json",), (None,)], "value string"), keep_raw=True)
    valid, dead = validate_events(df)
    assert valid.count() == 0
    rows = dead.collect()
    assert len(rows) == 2
    assert all(r["error"] == "event_id,user_id,action,product_id,ip_address,event_ts" for r in rows)
    assert {r["raw"] for r in rows} == {"not json", None}


def test_m5_missing_fields_named(spark):
    valid, dead = validate_events(batch(spark, ['{"event_id": "x"}']))
    assert valid.count() == 0
    assert dead.first()["error"] == "user_id,action,product_id,ip_address,event_ts"


def test_m6_extra_field_dropped(spark):
    t = msg(1, "1.2.3.4", extra="zzz")
    df = batch(spark, [t], keep_raw=False)
    assert df.columns == ["event_id", "user_id", "action", "product_id", "ip_address", "event_ts"]
    valid, dead = validate_events(df)
    assert (valid.count(), dead.count()) == (1, 0)


def test_m7_bad_time_is_dead_letter_not_exception(spark):
    t = msg(1, "1.2.3.4").replace("2026-06-18T10:00:00.000000+00:00", "garbage")
    valid, dead = validate_events(batch(spark, [t]))
    assert valid.count() == 0
    assert dead.first()["error"] == "event_ts"


def test_encode_parse_round_trip(spark):
    ev = batch(spark, [msg(i, f"10.0.0.{i % 3}", i * 0.5) for i in range(20)], keep_raw=False)
    enc = encode_messages(ev)
    assert enc.first()["key"] == bytes(ev.first()["product_id"], "utf-8")
    back = parse_events(enc)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, ev.collect()))


# --- the rate rule (T1-T5) ---------------------------------------------------

def test_t1_count_at_threshold_not_flagged(spark):
    _, rates = _rates(spark, spread(25, "9.9.9.9", 4.0))
    r = rates.first()
    assert (r["n"], r["threshold"], r["is_bot"]) == (25, 25.0, False)


def test_t2_one_above_threshold_flagged(spark):
    _, rates = _rates(spark, spread(26, "9.9.9.9", 4.0))
    assert _flagged_ips(rates) == {"9.9.9.9"}


def test_t3_backlog_not_flagged(spark):
    _, rates = _rates(spark, spread(100, "9.9.9.9", 20.0))
    r = rates.first()
    assert (r["threshold"], r["is_bot"]) == (100.0, False)


def test_t4_backlog_plus_one_flagged(spark):
    _, rates = _rates(spark, spread(101, "9.9.9.9", 20.0))
    assert _flagged_ips(rates) == {"9.9.9.9"}


def test_t5_single_row_span_is_floor(spark):
    ev, rates = _rates(spark, [msg(1, "1.1.1.1")])
    s = batch_span(ev, DEFAULT).first()
    assert (s["raw_span_sec"], s["span_sec"]) == (0.0, 5.0)
    assert not rates.first()["is_bot"]


def test_old_fixed_count_rule_would_flag_backlog(spark):
    # 60 rows of one IP over 20 s: more than 25 per batch, but only 3 per second.
    _, rates = _rates(spark, spread(60, "8.8.8.8", 20.0))
    assert _flagged_ips(rates) == set()


def test_every_row_of_flagged_ip_is_flagged(spark):
    texts = spread(30, "6.6.6.6", 4.0) + spread(5, "7.7.7.7", 4.0, start=100)
    ev, rates = _rates(spark, texts)
    clean, flagged = split_events(ev, rates)
    assert flagged.count() == 30 and clean.count() == 5
    assert {r["ip_address"] for r in flagged.collect()} == {"6.6.6.6"}
    reason = flagged.first()["reason"]
    assert reason == "ip_rate_exceeded_5.0_events_per_sec_over_5.0s_span"


def test_reason_span_one_decimal(spark):
    texts = spread(200, "6.6.6.6", 12.34)
    ev, rates = _rates(spark, texts)
    assert rates.first()["reason"] == "ip_rate_exceeded_5.0_events_per_sec_over_12.3s_span"


def test_reason_rounds_half_up_on_exact_micros(spark):
    texts = [msg(0, "6.6.6.6", 0.0)] + [msg(i, "6.6.6.6", 6.25) for i in range(1, 40)]
    _, rates = _rates(spark, texts)
    assert rates.first()["reason"].endswith("_over_6.3s_span")


def test_no_bots_gives_typed_empty_flagged(spark):
    ev, rates = _rates(spark, spread(10, "1.1.1.1", 30.0))
    clean, flagged = split_events(ev, rates)
    assert flagged.count() == 0 and "reason" in flagged.columns
    assert clean.count() == 10


def test_all_bots(spark):
    ev, rates = _rates(spark, spread(40, "1.1.1.1", 2.0) + spread(40, "2.2.2.2", 2.0, start=100))
    clean, flagged = split_events(ev, rates)
    assert clean.count() == 0 and flagged.count() == 80
    m = batch_metrics(rates).first()
    assert (m["total_events"], m["legit_events"], m["flagged_events"], m["distinct_ips"],
            m["distinct_flagged_ips"]) == (80, 0, 80, 2, 2)


def test_t7_null_ips_dead_lettered_not_poisoning(spark):
    texts = [msg(i, None) for i in range(30)] + spread(10, "3.3.3.3", 30.0, start=100)
    raw = batch(spark, texts)
    valid, dead = validate_events(raw)
    assert dead.count() == 30 and set(r["error"] for r in dead.collect()) == {"ip_address"}
    ev = with_batch(valid)
    clean, flagged = split_events(ev, ip_rate(ev, DEFAULT))
    assert (clean.count(), flagged.count()) == (10, 0)


def test_multi_batch_keys_by_batch_id(spark):
    a = with_batch(batch(spark, spread(26, "9.9.9.9", 4.0), keep_raw=False), 1)
    b = with_batch(batch(spark, spread(20, "9.9.9.9", 4.0, start=500), keep_raw=False), 2)
    rates = ip_rate(a.unionByName(b), DEFAULT)
    got = {(r["batch_id"], r["is_bot"]) for r in rates.collect()}
    assert got == {(1, True), (2, False)}
