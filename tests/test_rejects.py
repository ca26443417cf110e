"""Bad landed documents are set aside and told; good ones are never held up or lost."""

import json
import os
import time
from datetime import date

import pytest

from equitylake.plans import price_load
from equitylake.sources import landed
from equitylake.sources.store import Store
from equitylake.specs import DAILY_PRICES
from equitylake.streaming.landing import ingest_available, read_rejects
from test_ingest import history, write

BAD = {
    "TORN": '{"historical": [{"date": "2024-01-02", "close": 1.0}, {"date": "2024-0',
    "NOTARR": '{"historical": "oops"}',
    "NODATE": '{"historical": [{"close": 3.0}]}',
    "NOTNUM": '{"historical": [{"date": "2024-01-02", "close": "n/a"}]}',
    "ARR": "[1]",
}


def land(landing):
    write(f"{landing}/symbol=GOOD/a.json", history([("2024-01-02", 1.0)]))
    write(f"{landing}/symbol=STR/a.json", '{"historical": [{"date": "2024-01-02", "open": "1.5", "close": 2}]}')
    write(f"{landing}/symbol=GONE/a.json", "{}")
    for symbol, text in BAD.items():
        write(f"{landing}/symbol={symbol}/a.json", text)


def test_backfill_sets_bad_documents_aside(spark, scratch):
    landing, staging = f"{scratch}/landing", f"{scratch}/staging"
    land(landing)
    universe = spark.createDataFrame([(s,) for s in ("GOOD", "STR", "GONE", *BAD)], "symbol string")
    assert price_load.stage(spark, universe, landing, staging) == (3, len(BAD))
    assert {r.symbol for r in price_load.read_rejects(spark, staging).collect()} == set(BAD)
    todo = price_load.staging_todo(universe, price_load.read_ledger(spark, staging))
    assert {r.symbol for r in todo.collect()} == set(BAD)
    store = Store(spark, f"{scratch}/store")
    assert price_load.load(store, staging) == 2
    assert [(r.symbol, r.open, r.close) for r in store.read(DAILY_PRICES).collect()] == [("GOOD", 1.0, 1.0), ("STR", 1.5, 2.0)]


def test_stream_sets_bad_documents_aside(spark, scratch):
    landing = f"{scratch}/landing"
    land(landing)
    store = Store(spark, f"{scratch}/store")
    ingest_available(spark, store, landing, f"{scratch}/ckpt")
    assert [r.symbol for r in store.read(DAILY_PRICES).collect()] == ["GOOD", "STR"]
    assert {r.symbol for r in read_rejects(store).collect()} == set(BAD)


@pytest.mark.parametrize("symbol", sorted(BAD))
def test_strict_refresh_names_the_symbol(spark, scratch, symbol):
    write(f"{scratch}/symbol={symbol}/a.json", BAD[symbol])
    with pytest.raises(Exception, match=f"unexpected price payload for symbol {symbol}"):
        price_load.landed_prices(spark, scratch).collect()


def test_the_later_landing_wins_whatever_its_name(spark, scratch):
    landing = f"{scratch}/landing"
    write(f"{landing}/symbol=AAPL/z.json", history([("2024-01-02", 1.0)]))
    write(f"{landing}/symbol=AAPL/a.json", history([("2024-01-02", 2.0)]))
    now = time.time()
    os.utime(f"{landing}/symbol=AAPL/z.json", (now - 60, now - 60))
    store = Store(spark, f"{scratch}/store")
    price_load.refresh_prices(store, landing)
    assert [r.close for r in store.read(DAILY_PRICES).collect()] == [2.0]
    ingest_available(spark, Store(spark, f"{scratch}/other"), landing, f"{scratch}/ckpt")
    assert [r.close for r in Store(spark, f"{scratch}/other").read(DAILY_PRICES).collect()] == [2.0]


def test_refresh_of_some_symbols_and_days_reads_only_their_directories(spark, scratch):
    landing = f"{scratch}/landing"
    for s in ("AAPL", "MSFT"):
        write(f"{landing}/symbol={s}/a.json", history([("2024-01-02", 1.0), ("2024-02-02", 2.0)]))
    write(f"{landing}/symbol=TORN/a.json", BAD["TORN"])
    rows = price_load.landed_prices(spark, landing, [" aapl"], date(2024, 2, 1))
    assert len(rows.inputFiles()) == 1 and "symbol=AAPL" in rows.inputFiles()[0]  # no other directory is listed or read
    store = Store(spark, f"{scratch}/store")
    assert price_load.refresh_prices(store, landing, ["AAPL"], start=date(2024, 2, 1)) == 1
    assert [(r.symbol, r.date) for r in store.read(DAILY_PRICES).collect()] == [("AAPL", date(2024, 2, 2))]


def test_csv_is_read_as_it_was_written(spark, scratch):
    names = ['Foo "Bar", Inc', "two\nlines", "back\\", '"', "plain"]
    write(f"{scratch}/part=0/a.csv", 'symbol,companyName,exchange\n' + "".join(
        'S{},"{}",NYSE\n'.format(i, n.replace('"', '""')) for i, n in enumerate(names)))
    rows = landed.read_profile_shards(spark, scratch, ["symbol", "companyName", "exchange"]).orderBy("symbol").collect()
    assert [(r.companyName, r.exchange) for r in rows] == [(n, "NYSE") for n in names]


def test_csv_row_of_another_width_fails(spark, scratch):
    write(f"{scratch}/part=0/a.csv", "symbol,companyName\nA,b\nC,d,e\n")
    with pytest.raises(Exception):
        landed.read_profile_shards(spark, scratch, ["symbol", "companyName"]).collect()


def test_wide_records_and_headers(spark, scratch):
    long = "x" * (1 << 21)
    write(f"{scratch}/part=1/a.json", json.dumps({"symbol": "A", "companyName": long}) + "\n" + json.dumps({"symbol": "B"}) + "\n")
    name = "h" * 200_000
    write(f"{scratch}/part=0/a.csv", f"symbol,{name}\nC,1\n")
    rows = {r.symbol: r for r in landed.read_profile_shards(spark, scratch, ["symbol", "companyName"]).collect()}
    assert set(rows) == {"A", "B", "C"} and rows["A"].companyName == long and rows["C"][name] == "1"


def bundle(landing, *lines):
    write(f"{landing}/symbol=~bundle/part-0.txt", "\n".join(lines))


def test_a_landing_has_no_file_for_each_symbol(spark, scratch):
    feed = spark.range(600).selectExpr("concat('S', id % 300) AS symbol", "date'2024-01-02' AS date", "1D AS open", "1D AS high", "1D AS low",
                                       "CAST(id AS double) AS close", "CAST(null AS double) AS adj_close", "id AS volume", "id AS seq")
    landed.write_price_histories(feed, scratch)
    assert sum(n.startswith("part-") for _, _, names in os.walk(scratch) for n in names) <= 8  # shuffle partitions
    rows = landed.shape_prices(landed.read_price_histories(spark, scratch)).collect()
    assert sorted((r.symbol, r.volume, r.close, r.adj_close) for r in rows) == sorted((f"S{i % 300}", i, float(i), None) for i in range(600))
    store = Store(spark, f"{scratch}/store")
    price_load.refresh_prices(store, scratch)
    assert sorted(r.volume for r in store.read(DAILY_PRICES).collect()) == list(range(300, 600))  # a symbol's later row wins


def test_a_bundle_names_its_symbols_line_by_line(spark, scratch):
    landing, staging = f"{scratch}/landing", f"{scratch}/staging"
    bundle(landing, "aapl\t" + history([("2024-01-02", 1.0)]), "A%09B\t" + history([("2024-01-02", 2.0)]), "GONE\t{}", "",
           "TORN\t" + history([("2024-01-02", 3.0)])[:30], "\t" + history([("2024-01-02", 4.0)]), "CUT OFF", "AAPL\t" + history([("2024-01-02", 5.0)]))
    write(f"{landing}/symbol=OWN/a.json", history([("2024-01-02", 6.0)]))
    want = {("AAPL", 5.0), ("A\tB", 2.0), ("OWN", 6.0)}
    universe = spark.createDataFrame([(s,) for s in ("AAPL", "A\tB", "GONE", "TORN", "OWN", "NEVER")], "symbol string")
    assert price_load.stage(spark, universe, landing, staging) == (4, 1)
    store = Store(spark, f"{scratch}/store")
    price_load.load(store, staging)
    assert {(r.symbol, r.close) for r in store.read(DAILY_PRICES).collect()} == want
    other = Store(spark, f"{scratch}/other")
    ingest_available(spark, other, landing, f"{scratch}/ckpt")
    assert {(r.symbol, r.close) for r in other.read(DAILY_PRICES).collect()} == want | {(None, 4.0)}
    assert sorted(str(r.symbol) for r in read_rejects(other).collect()) == ["None", "TORN"]
    # Only lines of the symbols asked for are parsed.
    rows = price_load.landed_prices(spark, landing, [" aapl", "own"]).collect()
    assert sorted((r.symbol, r.close) for r in rows) == [("AAPL", 1.0), ("AAPL", 5.0), ("OWN", 6.0)]
    with pytest.raises(Exception, match="unexpected price payload"):
        price_load.landed_prices(spark, landing).collect()


def test_shards_do_not_grow_with_the_symbols(spark, scratch, monkeypatch):
    monkeypatch.setattr(price_load, "MAX_SHARDS", 2)
    landing, staging = f"{scratch}/landing", f"{scratch}/staging"
    symbols = [f"S{i}" for i in range(12)]
    bundle(landing, *(f"{s}\t" + history([("2024-01-02", 1.0)]) for s in symbols))
    universe = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    assert price_load.stage(spark, universe, landing, staging, shard_size=1) == (12, 0)
    assert len([d for d in os.listdir(f"{staging}/data") if d.startswith("part=")]) == 2
    assert price_load.stage(spark, universe, landing, staging, shard_size=1) == (0, 0)
    store = Store(spark, f"{scratch}/store")
    assert price_load.load(store, staging) == 12
