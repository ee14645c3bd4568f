import os
import uuid

from strata.session import scratch_path
from strata.sources.csv import read_raw_csv, write_raw_csv
from tests.conftest import SF_SMALL
from strata.sources.layers import ANALYTICS, CURATED, RUNS, LayerStore
from strata.specs import REVIEWS, SELLERS


def _write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_multiline_quoted_record(spark):
    p = scratch_path(spark, "csv", uuid.uuid4().hex, "reviews.csv")
    _write_text(p, "review_id,order_id,review_score,review_comment_title,review_comment_message,"
                   "review_creation_date,review_answer_timestamp\n"
                   'r1,o1,5,"hi, there","line one\nline ""two""",2018-01-01 00:00:00,2018-01-02 00:00:00\n'
                   "r2,o2,4,,,2018-01-01 00:00:00,\n")
    rows = read_raw_csv(spark, p, REVIEWS).orderBy("review_id").collect()
    assert len(rows) == 2
    assert rows[0].review_comment_title == "hi, there"
    assert rows[0].review_comment_message == 'line one\nline "two"'
    assert rows[1].review_comment_title is None and rows[1].review_answer_timestamp is None


def test_plain_csv_nulls_short_rows_and_blanks(spark):
    p = scratch_path(spark, "csv", uuid.uuid4().hex, "sellers.csv")
    _write_text(p, 'seller_id,seller_zip_code_prefix,seller_city,seller_state\n'
                   's1,,"",SP\n'
                   's2,01234\n'
                   '  , 1 ,  x  ,RJ\n')
    rows = read_raw_csv(spark, p, SELLERS).collect()
    by_id = {r.seller_id: r for r in rows}
    assert by_id["s1"].seller_zip_code_prefix is None and by_id["s1"].seller_city is None
    assert by_id["s2"].seller_city is None and by_id["s2"].seller_state is None
    assert by_id["  "].seller_city == "  x  "          # surrounding blanks kept
    assert all(f.dataType.simpleString() == "string" for f in read_raw_csv(spark, p, SELLERS).schema)


def test_csv_round_trip_keeps_blanks(spark):
    df = spark.createDataFrame([("a", "  ", " x ", None)], SELLERS.raw_schema)
    p = scratch_path(spark, "csv", uuid.uuid4().hex)
    write_raw_csv(df, p, SELLERS)
    assert [tuple(r) for r in read_raw_csv(spark, p, SELLERS).collect()] == [("a", "  ", " x ", None)]


def test_layer_overwrite_round_trip(spark):
    store = LayerStore(scratch_path(spark, "layers", uuid.uuid4().hex))
    store.write(spark.range(5), CURATED, "t")
    store.write(spark.range(3), CURATED, "t")          # full replace
    assert store.read(spark, CURATED, "t").count() == 3


def test_header_is_checked_against_the_schema(spark):
    import pytest
    p = scratch_path(spark, "csv", uuid.uuid4().hex, "sellers.csv")
    _write_text(p, "seller_city,seller_id,seller_zip_code_prefix,seller_state\nc,s1,z,st\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, p, SELLERS).collect()


def test_failed_write_leaves_the_old_table(spark):
    import pytest
    from pyspark.sql import functions as F
    store = LayerStore(scratch_path(spark, "layers", uuid.uuid4().hex))
    store.write(spark.range(5), CURATED, "t")
    bad = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("no")).cast("long"))
                                .otherwise(F.col("id")).alias("id"))
    before = store.read(spark, CURATED, "t")
    with pytest.raises(Exception):
        store.write(bad, CURATED, "t")
    assert store.read(spark, CURATED, "t").count() == 5
    store.write(spark.range(2), CURATED, "t")
    assert store.read(spark, CURATED, "t").count() == 2
    assert before.count() == 5          # a reader of the version before is not cut off
    store.write(spark.range(1), CURATED, "t")
    published = store.published(spark)[f"{CURATED}/t"]
    left = [n for n in store._names(spark, store.path(CURATED, "t")) if store._finished(spark, f"{store.path(CURATED, 't')}/{n}")]
    assert len(left) == 2 and left[-1] == published
    with pytest.raises(FileNotFoundError):
        store.read(spark, CURATED, "missing")


def test_single_multiline_file_can_be_spread(spark):
    p = scratch_path(spark, "csv", uuid.uuid4().hex, "reviews.csv")
    rows = "".join(f'r{i},o{i},5,t,"line\nbreak {i}",2018-01-01 00:00:00,\n' for i in range(50))
    _write_text(p, "review_id,order_id,review_score,review_comment_title,review_comment_message,"
                   "review_creation_date,review_answer_timestamp\n" + rows)
    df = read_raw_csv(spark, p, REVIEWS, spread=3)
    assert df.rdd.getNumPartitions() == 3
    assert read_raw_csv(spark, p, REVIEWS).rdd.getNumPartitions() == 1
    assert sorted(r.review_id for r in df.collect()) == sorted(f"r{i}" for i in range(50))


def _broken(spark):
    from pyspark.sql import functions as F
    return spark.range(5).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))


def test_a_run_that_fails_between_tables_leaves_the_old_set(spark):
    import pytest
    store = LayerStore(scratch_path(spark, "layers", uuid.uuid4().hex))
    with store.begin(spark) as run:
        run.write(spark.range(5), CURATED, "orders")
        run.write(spark.range(50), CURATED, "items")
        with pytest.raises(FileNotFoundError):      # nothing to be seen before the end
            store.read(spark, CURATED, "orders")
        assert run.read(spark, CURATED, "orders").count() == 5
    with pytest.raises(Exception, match="lost"):
        with store.begin(spark) as run:
            run.write(spark.range(6), CURATED, "orders")   # finished, but of a run that fails
            run.write(_broken(spark), CURATED, "items")
    assert store.read(spark, CURATED, "orders").count() == 5
    assert store.read(spark, CURATED, "items").count() == 50
    with store.begin(spark) as run:                       # some tables only: the others stay
        run.write(spark.range(7), CURATED, "orders")
        assert run.read(spark, CURATED, "items").count() == 50
    assert store.read(spark, CURATED, "orders").count() == 7
    assert store.read(spark, CURATED, "items").count() == 50


def test_a_run_does_not_see_what_others_publish_meanwhile(spark):
    store = LayerStore(scratch_path(spark, "layers", uuid.uuid4().hex))
    store.write(spark.range(1), CURATED, "a")
    store.write(spark.range(1), CURATED, "b")
    run = store.begin(spark)
    with store.begin(spark) as other:
        other.write(spark.range(2), CURATED, "a")
        other.write(spark.range(2), CURATED, "b")
    assert [run.read(spark, CURATED, t).count() for t in "ab"] == [1, 1]
    run.write(spark.range(3), CURATED, "b")
    run.publish()                                         # its own table only
    assert [store.read(spark, CURATED, t).count() for t in "ab"] == [2, 3]


def test_unpublished_versions_go_when_they_are_old(spark):
    import pytest
    root = scratch_path(spark, "layers", uuid.uuid4().hex)
    store, hasty = LayerStore(root), LayerStore(root, unpublished_hours=0.0)
    for n in (1, 2, 3):
        store.write(spark.range(n), CURATED, "t")
    with pytest.raises(Exception, match="lost"):
        store.write(_broken(spark), CURATED, "t")         # a folder without success marker
    finished = store.write_version(spark.range(9), CURATED, "t")   # finished, never published
    names = lambda: store._names(spark, store.path(CURATED, "t"))
    assert len(names()) == 4
    assert store.clean(spark) == [] and len(names()) == 4  # may belong to a run still going on
    gone = hasty.clean(spark)
    assert len(gone) == 2 and any(p.endswith(finished) for p in gone)
    assert len(names()) == 2 and store.read(spark, CURATED, "t").count() == 3
    # publications that no table needs are gone as well
    assert len([n for n in store._names(spark, f"{root}/{RUNS}") if n.endswith(".json")]) == 2
    assert store.clean(spark) == []


def test_only_finished_versions_can_be_published(spark):
    import pytest
    store = LayerStore(scratch_path(spark, "layers", uuid.uuid4().hex))
    store.write(spark.range(4), ANALYTICS, "t")
    with pytest.raises(FileNotFoundError):
        store.publish(spark, {f"{ANALYTICS}/t": "v00000000000000000001-00000000"})
    assert store.read(spark, ANALYTICS, "t").count() == 4


def test_bucketed_tables_join_without_an_exchange(spark, cfg):
    """Orders, items and reviews bucketed by order: the order joins and aggregates of the marts read them as
    they lie, with the same results."""
    from strata.catalog import curated
    from strata.plans.marts import customer_rfm, daily_sales
    from strata.sources.layers import BY_ORDER
    plain = LayerStore(scratch_path(spark, "layers", uuid.uuid4().hex))
    store = LayerStore(scratch_path(spark, "layers", uuid.uuid4().hex), buckets=BY_ORDER, n_buckets=4)
    names = ("orders", "order_items", "reviews", "customers")
    with plain.begin(spark) as a, store.begin(spark) as b:
        for n in names:
            df = curated(spark, SF_SMALL, n)
            a.write(df, CURATED, n)
            b.write(df, CURATED, n)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("strata_")]
    t, u = ({n: s.read(spark, CURATED, n) for n in names} for s in (store, plain))
    for n in names:
        assert t[n].schema == u[n].schema and t[n].exceptAll(u[n]).count() == u[n].exceptAll(t[n]).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = t["orders"].join(t["order_items"].groupBy("order_id").count(), "order_id").join(t["reviews"], "order_id", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        for mart in (lambda x: daily_sales(x["orders"], x["order_items"], cfg),
                     lambda x: customer_rfm(x["orders"], x["order_items"], x["customers"], cfg)):
            got, want = mart(t), mart(u)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
            at_order = lambda df: df._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(order_id")
            assert at_order(want) >= 2 and at_order(got) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_balanced_write_splits_a_hot_partition(spark):
    from pyspark.sql import functions as F
    key = F.when(F.col("id") % 10 < 9, F.lit(0)).otherwise(F.col("id"))
    hot = spark.range(200_000).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")).repartition(8, "k")
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        sizes = []
        for balance in (False, True):
            store = LayerStore(scratch_path(spark, "layers", uuid.uuid4().hex), balance=balance)
            folder = store.write(hot, CURATED, "t")
            fs, at = store._fs(spark, folder)
            sizes.append([s.getLen() for s in fs.listStatus(at) if s.getPath().getName().endswith(".parquet")])
            assert store.read(spark, CURATED, "t").count() == 200_000
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert max(sizes[0]) > 0.85 * sum(sizes[0])          # one file holds the hot key
    assert max(sizes[1]) < 0.3 * sum(sizes[1]) and len(sizes[1]) > 4


def test_counts_of_written_tables_read_footers_only(spark):
    """The counts of layers and marts read no data page: they hold over files whose pages are overwritten."""
    import glob
    import os

    import pytest
    from pyspark.sql import functions as F
    from strata.operators import quality
    store = LayerStore(scratch_path(spark, "layers", uuid.uuid4().hex))
    df = spark.range(300_000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"))
    folder = store.write(df.coalesce(2), CURATED, "t").removeprefix("file:")
    for path in glob.glob(f"{folder}/part-*.parquet"):
        os.remove(os.path.join(folder, f".{os.path.basename(path)}.crc"))
        with open(path, "r+b") as f:
            f.seek(-8, os.SEEK_END)
            footer = 8 + int.from_bytes(f.read(4), "little")
            f.seek(4)
            f.write(bytes(os.path.getsize(path) - footer - 4))
    table = store.read(spark, CURATED, "t")
    assert quality.row_counts({"t": table}).first().value == 300_000
    with pytest.raises(Exception):
        table.agg(F.max("v")).collect()
