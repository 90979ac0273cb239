from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tradewind.session import scratch_root
from tradewind.sources import csv_files, provenance
from tradewind.sources.raw_zone import RawZone, ValidationError, key_counts, latest_per_key, merged
from tradewind.tables import SOURCE_TABLES, source_table

ITEM = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]


def coerced(spark, name, columns, *rows):
    frame = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    return csv_files.coerce(frame, source_table(name))


def test_declared_types(spark):
    row = coerced(
        spark, "order_items", ITEM, (" abc ", "2", "p1", "s1", "2018-01-05 10:00:00.75", "19.90", "7.50")
    ).first()
    assert row.order_id == "abc"
    assert row.order_item_id == 2
    assert row.price == Decimal("19.90")
    assert row.shipping_limit_date == dt.datetime(2018, 1, 5, 10)


def test_unparseable_values_become_null(spark):
    row = coerced(
        spark,
        "order_items",
        ITEM,
        ("abc", "not-a-number", "p1", "s1", "definitely not a date", "twelve", "7.50"),
    ).first()
    assert row.order_item_id is None and row.shipping_limit_date is None and row.price is None
    assert row.freight_value == Decimal("7.50")


def test_integers_pass_through_float_and_round_half_even(spark):
    frame = coerced(spark, "order_payments", ["payment_sequential"], ("2.5",), ("3.5",), ("1e2",), ("1e12",))
    assert [r.payment_sequential for r in frame.collect()] == [2, 4, 100, None]


def test_missing_columns_are_null_and_extra_ones_dropped(spark):
    frame = coerced(spark, "sellers", ["seller_state", "extra", "seller_id"], ("SP", "x", "s1"))
    assert frame.columns == source_table("sellers").columns
    assert frame.first().seller_city is None and frame.first().seller_id == "s1"


def test_missing_tokens_and_blank_text(spark):
    frame = coerced(spark, "sellers", ["seller_id", "seller_city"], ("s1", "NA"), ("s2", "  "), ("s3", "Nata"))
    assert [r.seller_city for r in frame.orderBy("seller_id").collect()] == [None, None, "Nata"]


def write_reviews(folder: Path) -> None:
    (folder / "market_order_reviews_dataset.csv").write_text(
        "review_id,order_id,review_score,review_comment_message\n"
        'r1,o1,5,"two\nlines, and ""quotes"""\n'
        "r2,o2,1,plain\n"
        "r3,o3,4,\n",
        encoding="utf-8",
    )


def test_csv_with_line_breaks_and_lineage(spark, tmp_path):
    write_reviews(tmp_path)
    frame = csv_files.read_table(spark, str(tmp_path), "order_reviews")
    rows = {r.review_id: r for r in frame.collect()}
    assert rows["r1"].review_comment_message == 'two\nlines, and "quotes"'
    assert rows["r3"].review_comment_message is None
    assert rows["r1"]._source_file == "market_order_reviews_dataset.csv"


def test_sample_mode(spark, tmp_path):
    write_reviews(tmp_path)
    assert csv_files.read_table(spark, str(tmp_path), "order_reviews", sample_rows=2).count() == 2
    (tmp_path / "product_category_name_translation.csv").write_text(
        "product_category_name,product_category_name_english\n" + "".join(f"a{i},b{i}\n" for i in range(5))
    )
    assert csv_files.read_table(spark, str(tmp_path), "product_category_translation", sample_rows=2).count() == 5


def test_missing_file(spark, tmp_path):
    with pytest.raises(csv_files.SourceFileMissingError):
        csv_files.read_table(spark, str(tmp_path), "orders")


def test_merge_updates_inserts_and_keeps(spark):
    schema = "k int, v string"
    target = spark.createDataFrame([(1, "old"), (2, "old")], schema)
    incoming = spark.createDataFrame([(2, "new b"), (2, "new a"), (3, "new")], schema)
    rows = sorted(tuple(r) for r in merged(target, incoming, ["k"]).collect())
    assert rows == [(1, "old"), (2, "new a"), (3, "new")]


def test_hot_key_is_thinned_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_per_key(frame, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def sellers(spark, *rows):
    return spark.createDataFrame(rows, source_table("sellers").schema)


def test_reload_changes_nothing_and_correction_updates_in_place(spark, tmp_path):
    zone = RawZone(spark, str(tmp_path))
    first = sellers(spark, ("s1", "1", "a", "SP"), ("s2", "2", "b", "RJ"))
    assert zone.load("sellers", first, "run1")["rows_in_table"] == 2
    loaded = {r.seller_id: r for r in zone.read("sellers").collect()}
    again = zone.load("sellers", first, "run2")
    assert again["rows_read"] == 2 and again["rows_in_table"] == 2 and again["strategy"] == "merge"
    zone.load("sellers", sellers(spark, ("s2", "2", "B!", "RJ"), ("s3", "3", "c", "MG")))
    now = {r.seller_id: r for r in zone.read("sellers").collect()}
    assert set(now) == {"s1", "s2", "s3"} and now["s2"].seller_city == "B!"
    assert now["s2"]._loaded_at > loaded["s2"]._loaded_at
    assert all(r._source_file and r._loaded_at for r in now.values())
    assert zone.audit().count() == 3
    status = {r.table_name: r for r in zone.load_status().collect()}
    assert len(status) == 9 and status["sellers"].rows_in_table == 3 and status["orders"].last_loaded is None


def folders(zone, name, version=None):
    return {r["bucket"]: r["folder"] for r in zone.manifest(name, version).collect()}


def test_a_merge_of_one_key_rewrites_one_bucket(spark, tmp_path):
    zone = RawZone(spark, str(tmp_path), buckets=16)
    rows = [(f"s{i}", f"{i}", "city", "SP") for i in range(500)]
    first = zone.load("sellers", sellers(spark, *rows))
    before = folders(zone, "sellers")
    assert first["buckets_written"] == len(before) == 16
    files = {f: f.stat().st_mtime_ns for f in Path(tmp_path).rglob("*.parquet")}
    done = zone.load("sellers", sellers(spark, ("s7", "7", "MOVED", "RJ")))
    after = folders(zone, "sellers")
    changed = [b for b in before if before[b] != after[b]]
    assert done["buckets_written"] == len(changed) == 1 and done["rows_in_table"] == 500
    assert all(f.stat().st_mtime_ns == t for f, t in files.items()), "nothing that was there is touched"
    now = {r.seller_id: r.seller_city for r in zone.read("sellers").collect()}
    assert len(now) == 500 and now.pop("s7") == "MOVED" and set(now.values()) == {"city"}


def test_a_merge_writes_its_rows_once_and_a_file_per_bucket(spark, tmp_path):
    zone = RawZone(spark, str(tmp_path), buckets=16)
    scratch = Path(scratch_root(spark))
    before = set(scratch.glob("*"))
    rows = [(f"s{i}", f"{i}", "city", "SP") for i in range(3000)]
    zone.load("sellers", sellers(spark, *rows))
    zone.load("sellers", sellers(spark, *((k, z, "moved", s) for k, z, _, s in rows[::2])))
    assert set(scratch.glob("*")) == before, "no copy beside the buckets"
    written = [list(Path(tmp_path, "raw", "sellers", f).glob("*.parquet")) for f in folders(zone, "sellers").values()]
    assert len(written) == 16 and max(map(len, written)) == 2, "one of new rows, one of rows that stay"
    cities = [r.seller_city for r in zone.read("sellers").collect()]
    assert (cities.count("moved"), cities.count("city")) == (1500, 1500)


def test_any_series_of_merges_equals_merging_whole_tables(spark, tmp_path):
    zone = RawZone(spark, str(tmp_path), buckets=4)
    columns = source_table("sellers").columns
    whole = spark.createDataFrame([], source_table("sellers").schema)
    for step in range(4):
        rows = [(f"s{i * 7 % 23}" if i % 6 else None, f"{step}", f"c{step}-{i}", "SP") for i in range(step, 20 + step)]
        batch = sellers(spark, *rows)
        whole = spark.createDataFrame(merged(whole, batch, ["seller_id"]).collect(), whole.schema)
        zone.load("sellers", batch)
        assert sorted(map(tuple, zone.read("sellers").select(*columns).collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_superseded_buckets_go_and_the_version_before_stays(spark, tmp_path):
    zone = RawZone(spark, str(tmp_path), buckets=2)
    held = []
    for step in range(4):
        zone.load("sellers", sellers(spark, *((f"s{i}", str(step), "c", "SP") for i in range(20))))
        held.append(zone.read("sellers"))
    assert held[3].count() == held[2].count() == 20
    versions = {p.parent.name for p in Path(tmp_path).glob("raw/sellers/*/bucket=*")}
    assert versions == {r["version"] for r in zone.audit().orderBy(F.desc("sequence")).limit(2).collect()}


def test_the_last_load_is_current_whatever_the_clock_says(spark, tmp_path, monkeypatch):
    zone = RawZone(spark, str(tmp_path))

    class Backwards:
        now = staticmethod(lambda tz=None: dt.datetime(2030 - len(calls), 1, 1, tzinfo=tz))

    calls = []
    monkeypatch.setattr("tradewind.sources.raw_zone.datetime", Backwards)
    for city in ("first", "second", "third"):
        calls.append(city)
        zone.load("sellers", sellers(spark, ("s1", "1", city, "SP")))
        assert zone.read("sellers").first().seller_city == city


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    zone = RawZone(spark, str(tmp_path))
    zone.load("sellers", sellers(spark, ("s1", "1", "a", "SP")))
    assert zone.load("sellers", spark.createDataFrame([], source_table("sellers").schema))["buckets_written"] == 0
    assert zone.read("sellers").count() == 1


def test_full_refresh_replaces_and_keeps_duplicates(spark, tmp_path):
    zone = RawZone(spark, str(tmp_path))
    schema = source_table("geolocation").schema
    point = ("1", -10.0, -50.0, "x", "SP")
    zone.load("geolocation", spark.createDataFrame([point, point], schema))
    assert zone.read("geolocation").count() == 2
    held = zone.read("geolocation")
    zone.load("geolocation", spark.createDataFrame([point], schema))
    assert zone.read("geolocation").count() == 1
    assert held.count() == 2, "a reader of the old version keeps seeing it"


def test_reset_empties_loaded_tables(spark, tmp_path):
    zone = RawZone(spark, str(tmp_path))
    zone.load("sellers", sellers(spark, ("s1", "1", "a", "SP")))
    assert zone.reset() == ["sellers"]
    assert zone.read("sellers").count() == 0


def test_validation(spark, tmp_path):
    zone = RawZone(spark, str(tmp_path))
    zone.load("sellers", sellers(spark, ("s1", "1", "a", "SP")))
    found = {(r["table_name"], r["rule"]): (r["measured"], r["passed"]) for r in zone.validation(strict=True).collect()}
    assert {rule: found[("sellers", rule)] for rule in ("loaded", "filled", "distinct_keys")} == {"loaded": (1, True), "filled": (1, True), "distinct_keys": (0, True)}
    assert found[("sellers", "as_published")][0] > 0.9 and not found[("sellers", "as_published")][1]
    assert found[("orders", "loaded")] == (0, False) and ("orders", "filled") not in found
    with pytest.raises(ValidationError, match="orders breaks loaded") as caught:
        zone.assert_valid()
    assert len(caught.value.rows) == 8


def test_key_counts(spark):
    frame = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int")
    assert tuple(key_counts(frame, ["k"]).first()) == (4, 2)
    assert tuple(key_counts(frame.limit(0), ["k"]).first()) == (0, 0) and tuple(key_counts(frame, []).first()) == (4, 0)


def test_provenance(spark, tmp_path):
    folder = str(tmp_path)
    assert provenance.read(spark, folder).source == "unknown"
    provenance.write(spark, folder, provenance.REAL_SOURCE, "extract", files=9)
    record = provenance.read(spark, folder)
    assert record.is_real_data and record.detail == {"files": "9"} and record.written_at
    zone = RawZone(spark, str(tmp_path / "zone"))
    assert zone.is_strict_by_default(folder) and not zone.is_strict_by_default(folder, sampled=True)
    (tmp_path / "bad" / provenance.MARKER).mkdir(parents=True)
    (tmp_path / "bad" / provenance.MARKER / "part.json").write_text("{not json")
    assert provenance.read(spark, str(tmp_path / "bad")).source == "unknown"


def test_every_source_loads_from_csv(spark, sf_dir, tmp_path):
    from tradewind.sources import market

    for table in SOURCE_TABLES:
        path = f"{tmp_path}/csv/{table.file.replace('*', 'x_')}"
        market.read(spark, sf_dir, table.name).write.option("escape", '"').csv(path, header=True)
    zone = RawZone(spark, f"{tmp_path}/zone")
    results = zone.load_all(f"{tmp_path}/csv", run_id="r")
    assert [r["table"] for r in results] == [t.name for t in SOURCE_TABLES]
    assert all(r["rows_read"] == r["rows_in_table"] > 0 for r in results)
    zone.assert_valid()
