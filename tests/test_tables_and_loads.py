"""Published snapshots, incremental marts, quoted CSV in splits, the compacted log, and plans."""

from __future__ import annotations

import datetime as dt
import json
import random
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SALES, SF, rows, staged_frame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyline.functions.ranking import rank_descending
from tallyline.operators import core, kpis, marts, metrics, runlog, staging
from tallyline.plans import jobs
from tallyline.registry.base import Inputs
from tallyline.schemas import RUN_LOG
from tallyline.session import compile_wide_projections
from tallyline.settings import Settings
from tallyline.sources import files, tables
from tallyline.sources.quoted_csv import records
from tallyline.sources.sales_csv import read_sales_csv
from tallyline.sources.snapshots import NoSuchTable, StaleSnapshot, TableStore, Transaction
from tallyline.streaming import incremental


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ---- snapshots ----------------------------------------------------------------------------

def numbers(spark, *values):
    return spark.createDataFrame([(v, v % 3) for v in values], "v int, part int")


def test_a_write_killed_between_two_files_leaves_the_old_tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    with store.begin() as txn:
        assert txn.write("a", numbers(spark, 1, 2)) == 2 and txn.write("b", numbers(spark, 3)) == 1
    before = store.snapshot()

    # Two tasks, of which the second dies: its first file is there, the job is not.
    boom = spark.range(2, numPartitions=2).select(
        F.when(F.col("id") == 1, F.raise_error(F.lit("killed")).cast("int")).otherwise(7).alias("v"))
    with pytest.raises(Exception, match="killed"):
        with store.begin() as txn:
            txn.write("a", numbers(spark, 5, 6))
            txn.write("b", boom)
    # As a killed driver would leave it: written, neither published nor cleaned up.
    lost = store.begin()
    lost.write("a", numbers(spark, 9))
    for reader in (before, store.snapshot(), TableStore(spark, store.root).snapshot()):
        assert sorted(rows(reader.read("a"), "v")) == [(1,), (2,)]
        assert rows(reader.read("b"), "v") == [(3,)]
    assert tables.full_refresh(numbers(spark, 4), store.root + "-t").count() == 1


def test_snapshots_are_read_while_new_ones_are_published(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    with store.begin() as txn:
        txn.write("a", numbers(spark, 1))
    old = store.snapshot()
    slow, fast = store.begin(), store.begin()
    fast.write("a", numbers(spark, 2))
    fast.commit()
    slow.write("a", numbers(spark, 3))
    with pytest.raises(StaleSnapshot):
        slow.commit()
    assert rows(old.read("a"), "v") == [(1,)] and rows(store.read("a"), "v") == [(2,)]
    for v in (4, 5, 6):
        with store.begin() as txn:
            txn.write("a", numbers(spark, v))
    store.expire(keep=2)
    assert store._versions() == [4, 5] and rows(store.snapshot(4).read("a"), "v") == [(5,)]
    with pytest.raises(NoSuchTable):
        store.read("none")


def test_partitions_are_replaced_alone(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    with store.begin() as txn:
        txn.write("t", numbers(spark, 0, 1, 2, 3, 4, 5), "part")
    first = store.snapshot().tables["t"].folders
    with store.begin() as txn:
        assert txn.write("t", numbers(spark, 10), "part", replace=[1, 2]) == 1
        assert sorted(rows(txn.read("t"), "v")) == [(0,), (3,), (10,)]
    now = store.snapshot().tables["t"].folders
    assert now["part=0"] == first["part=0"] and now["part=1"] != first["part=1"] and "part=2" not in now
    with store.begin() as txn:
        txn.write("t", numbers(spark, 6), "part", append=True)
    df = store.read("t")
    assert sorted(rows(df, "v")) == [(0,), (3,), (6,), (10,)] and df.columns == ["v", "part"]
    assert "PartitionFilters: [isnotnull(part" in plan_of(df.filter("part = 1"))
    with store.begin() as txn:
        txn.write("t", numbers(spark).limit(0), "part")
    assert store.read("t").count() == 0


def test_staged_tables_have_an_owner(spark):
    folder = tables.shared_folder(spark)
    before = set(files.names(spark, folder))
    with pytest.raises(ZeroDivisionError), tables.staging_scope(spark):
        assert tables.stage_table(spark.range(3), "mine").count() == 3
        assert set(files.names(spark, folder)) != before
        1 // 0
    assert set(files.names(spark, folder)) == before
    one = tables.stage_table(spark.range(3), "mine")
    tables.drop_staged(one)
    assert set(files.names(spark, folder)) == before


def raw_file(path, n=30):
    lines = ["transaction_id,date,product_name,product_category,region,sales_rep,customer_id,"
             "customer_segment,channel,units_sold,unit_price,revenue,cost,discount_pct"]
    for i in range(n):
        date = "never" if i % 10 == 9 else f"20{19 + i % 2}-0{1 + i % 9}-11"
        lines.append(f"k{i},{date},P{i % 4},Cat,North,Rep{i % 3},C{i},SMB,Online,2,10,{20 + i},5,0")
    path.write_text("\n".join(lines) + "\n")


def test_a_run_has_stamps_few_jobs_and_leaves_only_its_tables(spark, tmp_path):
    raw, root = tmp_path / "raw.csv", str(tmp_path / "run")
    raw_file(raw)
    before = set(files.names(spark, tables.shared_folder(spark)))
    at = dt.datetime(2024, 5, 1, 3)
    result = jobs.run_all(spark, str(raw), root, at.date(), loaded_at=at).collect()
    assert [(r.stage, r.success, r.records) for r in result][:2] == [("ingest", True, 27), ("transform", True, 27)]
    assert result[0].rejected == 3
    assert set(files.names(spark, tables.shared_folder(spark))) == before
    folder = jobs.RunFolder(root)
    stamps = {"core_sales": "transformed_at", "rpt_anomalies": "detected_at", "stg_sales_raw": "loaded_at"}
    for name, stamp in (stamps | {m: "refreshed_at" for m in jobs.made_marts()}).items():
        df = folder.read(spark, name)
        assert df.schema[stamp].dataType.simpleString() == "timestamp"
        assert {v for (v,) in rows(df, stamp)} <= {at} and (df.count() or name == "rpt_anomalies")
    plan = plan_of(kpis.kpi_set(kpis.sliced(folder.read(spark, "core_sales"), txn_year=2019)))
    assert "PartitionFilters: [isnotnull(txn_year" in plan and "txn_date" in plan.split("PushedFilters")[1]
    found = files.names(spark, f"{root}/_snapshots")
    assert len(json.loads((tmp_path / "run/_snapshots" / found[-1]).read_text())["tables"]) >= 12


def test_published_tables_and_raw_files_take_little_disk(spark, tmp_path):
    """Tables are packed as the session says, or else by zstd; raw files, of bounded rows, by gzip."""
    def codecs(name):
        store = TableStore(spark, str(tmp_path / name))
        with store.begin() as txn:
            txn.write("t", numbers(spark, *range(50)))
            txn.write("by_part", numbers(spark, *range(50)), partition_by="part")
        assert store.read("t").count() == store.read("by_part").count() == 50
        return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression
                for f in (tmp_path / name).rglob("*.parquet")}

    assert codecs("usual") == {"ZSTD"}
    spark.conf.set("spark.sql.parquet.compression.codec", "gzip")
    try:
        assert codecs("named") == {"GZIP"}
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")

    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    raw = spark.createDataFrame(
        [("T,1" if i % 7 else None, f'said "{i}"', " x ") for i in range(50)], "a string, b string, c string")
    tables.write_csv(raw.coalesce(1), plain)
    tables.write_csv(raw.coalesce(1), packed, "gzip", 20)
    assert [n[-4:] for n in files.names(spark, plain) if n.startswith("part")] == [".csv"]
    assert [n[-7:] for n in files.names(spark, packed) if n.startswith("part")] == [".csv.gz"] * 3
    assert rows(read_sales_csv(spark, plain).orderBy("b")) == rows(read_sales_csv(spark, packed).orderBy("b"))


def test_a_run_gives_back_the_shuffle_of_its_copies_before_the_fact(spark, tmp_path, monkeypatch):
    raw, root, given = tmp_path / "raw.csv", str(tmp_path / "run"), []
    raw_file(raw)

    def watched(session):
        (made,) = (tmp_path / "run/data").glob("*/stg_sales_clean/_SUCCESS")
        given.append(not list((tmp_path / "run/data").glob("*/core_sales")) and made.exists())
        tables.forget_shuffles(session)

    monkeypatch.setattr(jobs, "forget_shuffles", watched)
    result = jobs.run_all(spark, str(raw), root, dt.date(2024, 1, 31)).collect()
    assert all(r.success for r in result) and given == [True]


def test_lines_of_an_order_stay_together_in_the_input(spark):
    """The last join that can shuffle the fact is by order, so copies of an id meet in one task."""
    at = Inputs(spark, SF).sales_raw("customer", "part").select("transaction_id", F.spark_partition_id().alias("task"))
    order = F.regexp_extract("transaction_id", "TXN-([0-9]+)-", 1)
    tasks = at.where("transaction_id like 'TXN%'").groupBy(order).agg(F.countDistinct("task").alias("n"))
    large = {"autoBroadcastJoinThreshold": "-1", "adaptive.coalescePartitions.enabled": "false"}
    for key, value in large.items():
        spark.conf.set(f"spark.sql.{key}", value)
    try:
        assert tasks.agg(F.max("n")).first()[0] == 1
    finally:
        for key in large:
            spark.conf.unset(f"spark.sql.{key}")


def test_year_ranges():
    text = str(kpis.in_years([2020, 2019, 2022]))
    assert text.count("OR") + text.count("or(") == 1 and "2019-01-01" in text and "2020-12-31" in text


# ---- incremental marts --------------------------------------------------------------------

def batches(spark):
    rng = random.Random(8)

    def line(i, day):
        base = list(SALES[rng.randrange(len(SALES))])
        base[0] = f"t{i}"
        base[11], base[12] = str(rng.randrange(0, 900)), str(rng.randrange(0, 500))
        return (*base,), day

    lines = [[line(i, 1) for i in range(30)], [line(i, 2) for i in range(20, 50)],
             [((f"t{i}", "2021-05-05", *SALES[0][2:]), 3) for i in (3, 25, 60, 60)]]
    for part in lines:
        yield staged_frame(spark, [r for r, _ in part]).withColumn(
            "loaded_at", F.lit(dt.datetime(2024, 1, part[0][1])))


@pytest.mark.parametrize("policy", ["keep_first", "keep_latest"])
def test_incremental_marts_equal_a_full_refresh(spark, tmp_path, policy):
    store = TableStore(spark, str(tmp_path / "store"))
    order = ("loaded_at", "revenue", "cost", "record_date", "product_name")
    every, seen = None, []
    for batch in batches(spark):
        every = batch if every is None else every.unionByName(batch)
        incremental.apply_batch(store, batch, order=order, policy=policy)
        seen.append(store.snapshot())
    if policy == "keep_first":
        single = staging.keep_first(every, order=order)
    else:
        w = Window.partitionBy("transaction_id").orderBy(*(F.desc(c) for c in order))
        single = every.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")
    fact = core.enrich(single)
    assert sorted(map(str, rows(store.read("core_sales").drop("transformed_at")))) == sorted(map(str, rows(fact)))
    for name, mart in marts.all_marts(fact).items():
        got = store.read(name).drop("refreshed_at")
        assert got.dtypes == mart.dtypes and sorted(map(str, rows(got))) == sorted(map(str, rows(mart))), name
    # The last batch has rows of 2021 only (and, with keep_latest, takes rows from other years).
    old, new = (s.tables["rpt_monthly_revenue"].folders for s in seen[1:])
    same = {f for f in old if old[f] == new.get(f)}
    assert "txn_year=2021" in new and (same == set(old) if policy == "keep_first" else same != set(old))
    # Once more changes nothing.
    counts = incremental.apply_batch(store, batch, order=order, policy=policy)
    assert sorted(map(str, rows(store.read("rpt_product_summary").drop("refreshed_at")))) == sorted(
        map(str, rows(marts.product_summary(fact))))
    assert policy == "keep_latest" or counts["added"] == 0


@pytest.mark.parametrize("policy", ["keep_first", "keep_latest"])
def test_rows_of_the_fact_are_not_dealt_anew_to_be_written(spark, tmp_path, monkeypatch, policy):
    store, plans = TableStore(spark, str(tmp_path / "store")), []
    write = Transaction.write

    def watched(self, name, df, *more, **named):
        if name == "core_sales":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, name, df, *more, **named)

    monkeypatch.setattr(Transaction, "write", watched)
    for batch in batches(spark):
        incremental.apply_batch(store, batch, policy=policy)
    assert len(plans) == 3 and not any("Repartition" in p or "Rebalance" in p for p in plans)


def test_wide_projections_are_compiled_in_a_session_of_any_kind():
    def session(**given):
        said = {}
        return said, SimpleNamespace(
            sparkContext=SimpleNamespace(getConf=lambda: given), conf=SimpleNamespace(set=said.__setitem__))

    key = "spark.sql.codegen.hugeMethodLimit"
    for given, wanted in (({}, {key: "8000"}), ({key: "65535"}, {})):
        said, one_ = session(**given)
        compile_wide_projections(one_)
        assert said == wanted


# ---- CSV ----------------------------------------------------------------------------------

ODD_FIELDS = [
    "plain", "", "two\nlines", 'a "quoted" word', 'line\n"and"\nquote', "comma, here", "\n\n\n",
    "long " * 30 + "\n" + "x" * 90, '"', "ends with break\n", "Ünïcödé\nß",
]


def odd_csv(path, n, end="\n"):
    rng = random.Random(n)

    def quoted(text):
        return '"' + text.replace('"', '""') + '"' if set(text) & set(',"\n') or rng.random() < 0.3 else text

    lines = ["id,first,second"]
    lines += [",".join(map(quoted, (f"r{i}", rng.choice(ODD_FIELDS), rng.choice(ODD_FIELDS)))) for i in range(n)]
    path.write_bytes((end.join(lines) + end).encode())


@pytest.mark.parametrize("split", [97, 1000, 1 << 20])
def test_quoted_line_breaks_in_splits(spark, tmp_path, split):
    odd_csv(tmp_path / "a.csv", 150)
    odd_csv(tmp_path / "b.csv", 7)
    path = str(tmp_path / "*.csv")
    plain = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    want = sorted(map(str, rows(plain)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = records(spark, path)
        assert found.count() == 150 + 7 + 2
        if split == 97:
            assert spark.read.text(path).rdd.getNumPartitions() > 50
        got = read_sales_csv(spark, path, multiline=True).drop("_malformed")
        names = ["id", "first", "second"]
        # Tokens for "no value" do not occur but for the empty text, which both read as NULL.
        assert sorted(map(str, rows(got, *names))) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_quoted_csv_edges(spark, tmp_path):
    (tmp_path / "crlf.csv").write_bytes(b'id,first,second\r\nr1,a,"b\r\nc"\r\n\r\nr2,,\r\nr3,too,many,fields\r\n')
    got = read_sales_csv(spark, str(tmp_path / "crlf.csv"), multiline=True)
    said = {r[0]: tuple(r) for r in got.collect()}
    assert said["r2"][:3] == ("r2", None, None) and said["r1"][1] == "a" and said["r1"][2].split() == ["b", "c"]
    assert [r[3] is not None for r in got.collect() if r[0] == "r3" or r[0] is None] == [True]
    (tmp_path / "other.csv").write_text("id,second,first\nx,y,z\n")
    with pytest.raises(ValueError, match="header"):
        read_sales_csv(spark, str(tmp_path / "*.csv"), multiline=True)
    (tmp_path / "open.csv").write_text('id,first,second\nr1,"never\nclosed,x\n')
    assert records(spark, str(tmp_path / "open.csv")).count() == 2


# ---- log ----------------------------------------------------------------------------------

def test_a_thousand_runs_leave_few_files(spark, tmp_path):
    path, n = str(tmp_path / "log"), 0
    (tmp_path / "log").mkdir()
    kinds = pa.schema([
        ("log_id", pa.int64()), ("run_date", pa.date32()), ("stage", pa.string()), ("status", pa.string()),
        ("message", pa.string()), ("records_processed", pa.int64()), ("start_time", pa.timestamp("us", "UTC")),
        ("end_time", pa.timestamp("us", "UTC")), ("error_message", pa.string())])
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)

    def run_once(i):
        for status, end in (("Started", None), ("Completed", start + dt.timedelta(seconds=i + 1))):
            line = dict(zip(kinds.names, (i, dt.date(2024, 1, 1), "Staging", status, None, i, start, end, None)))
            pq.write_table(pa.Table.from_pylist([line], kinds), f"{path}/part-{i}-{status}.parquet")

    for group in range(10):
        for _ in range(100):
            run_once(n)
            n += 1
        assert runlog.compact(spark, path) == 200
        assert runlog.compact(spark, path) == 0
        assert len(files.data_files(spark, path)) <= 400
    assert len(files.data_files(spark, f"{path}/_merged/data")) < 25
    run_once(n)
    events = runlog.read(spark, path)
    assert events.count() == 2002 and events.schema == RUN_LOG
    state = runlog.current_state(events)
    assert state.count() == 1001 and rows(state.select("status").distinct()) == [("Completed",)]
    assert runlog.read(spark, str(tmp_path / "none")).count() == 0


def test_merges_of_two_writers_keep_each_event_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    for i in range(4):
        log = jobs.AuditLog(spark, path, dt.date(2024, 1, 1))
        log.run("Staging", lambda: i)
    real = TableStore.publish

    def raced(self, base, published):
        monkeypatch.setattr(TableStore, "publish", real)
        assert runlog.compact(spark, path, most=2) == 8
        return real(self, base, published)

    monkeypatch.setattr(TableStore, "publish", raced)
    assert runlog.compact(spark, path, most=2) == 0
    assert runlog.read(spark, path).count() == 8


# ---- operators ----------------------------------------------------------------------------

def test_million_equal_values_are_one_row(spark):
    df = spark.range(1_000_000).select(
        F.lit("g").alias("g"), F.when(F.col("id") < 999_000, 5).otherwise(F.col("id")).alias("v"))
    got = rank_descending(df, ["g"], "v", "r")
    assert rows(got.filter("v = 5").select("r").distinct()) == [(1001,)]
    assert rows(got.filter("v > 5").agg(F.min("r"), F.max("r"), F.countDistinct("r"))) == [(1, 1000, 1000)]
    # Windows stand above the counts per value, never above the rows.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "Range (" not in plan.split("Window")[-1]


@pytest.mark.parametrize("slots", [1, 64, 1 << 20])
def test_drop_all_by_bitmap(spark, slots):
    lines = [(f"k{i}" if i % 7 else None, i) for i in range(300)] + [(f"k{i}", -i) for i in range(0, 300, 11)]
    lines += [("hot", i) for i in range(500)]
    df = spark.createDataFrame(lines, "transaction_id string, v int")
    got = sorted(map(str, rows(staging.drop_all_copies(df, slots=slots))))
    count = {}
    for k, _ in lines:
        count[k] = count.get(k, 0) + 1
    assert got == sorted(str((k, v)) for k, v in lines if k is None or count[k] == 1)


def test_single_keys_are_not_shuffled(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("transaction_id"), F.lit("x" * 50).alias("wide"))
    kept = staging.drop_all_copies(df, slots=1 << 24)
    sure = kept._jdf.queryExecution().optimizedPlan().toString().split("Union")[1]
    assert kept.count() == 1000 and sure.index("Join LeftOuter") < sure.index("Aggregate")


def test_every_column_is_filled(spark):
    rng = random.Random(2)
    lines = []
    for i in range(120):
        lines.append((rng.choice(["a", "b", None]), "m", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i), i,
                      *(rng.choice([None, None, i + j]) for j in range(3))))
    df = spark.createDataFrame(
        lines, "entity_id string, metric_name string, loaded_at timestamp, n int, x int, y int, z int")
    got = sorted(rows(metrics.forward_fill(df, tie_break=("n",))), key=lambda r: r[3])
    last: dict = {}
    for want, have in zip(lines, got):
        state = last.setdefault(want[0], [None] * 3)
        for j in range(3):
            state[j] = want[4 + j] if want[4 + j] is not None else state[j]
        assert have == (*want[:4], *state)


def test_fill_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.createDataFrame([("e", "m", dt.datetime(2024, 1, 1), 1)],
                          "entity_id string, metric_name string, loaded_at timestamp, x int").write.parquet(path)
    plan = plan_of(metrics.forward_fill(spark.read.parquet(path)))
    assert path not in plan  # only the staged copy is read from here on


def test_orphans_count_all_relations_in_one_pass(spark):
    fact = core.enrich(staged_frame(spark, SALES))
    regional = marts.regional_summary(fact).filter("region <> 'South'")
    products = marts.product_summary(fact).filter("product_name <> 'Paper'")
    monthly = marts.monthly_revenue(fact).withColumnRenamed("month_label", "txn_month_label")
    relations = {"regional": (regional, ["region", "txn_year"]), "monthly": (monthly, ["txn_month_label"]),
                 "products": (products, ["product_name", "txn_year"])}
    from tallyline.operators import views

    want = [("monthly", 0), ("products", 2), ("regional", 2)]
    assert sorted(rows(views.orphan_counts(fact, relations))) == want
    assert sorted(rows(views.orphan_counts(marts.revenue_cube(fact), relations))) == want


def test_settings_still_choose_the_policy(spark):
    df = staged_frame(spark, [*SALES, SALES[0]]).withColumn("loaded_at", F.lit(dt.datetime(2024, 1, 1)))
    for policy, left in (("keep_first", len(SALES)), ("drop_all", len(SALES) - 1)):
        assert jobs.clean_staging(df, Settings(dedup=policy)).count() == left
