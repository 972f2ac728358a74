"""What a step may write and deal out: wide rows not twice, and not at all where their keys are enough."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from brokerflow.checks import queries
from brokerflow.checks.book import Book
from brokerflow.functions.payload import is_object_text
from brokerflow.operators import joins, mapping, quality, star, upsert
from brokerflow.plans import landing, scratch, views
from brokerflow.plans.batch import POLICIES, BatchRun, run_batch
from brokerflow.plans.tables import Tables
from brokerflow.sources import envelopes as ev
from tests.test_envelopes import log
from tests.test_runs import AS_OF, policy, tables_after
from tests.test_star import CLAIM_SCHEMA, claim


def deals(df) -> int:
    """How often a plan deals rows out by a key."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_places_are_counted_once(spark):
    messages = log(spark, ["{}", '{"a": 1}', "{}"])
    kept = ev.drop_redelivered(messages.unionByName(messages.where("offset = 1")))
    assert deals(kept) == 1  # the repeated messages alone; the places were counted when the plan was built
    assert [r.offset for r in kept.orderBy("offset").collect()] == [0, 1, 2]


def test_messages_without_a_place_are_nobodys_repeat(spark):
    messages = log(spark, ["{}", '{"a": 1}']).withColumn("offset", F.lit(None).cast("long"))
    assert ev.drop_redelivered(messages.unionByName(messages)).count() == 4


@pytest.mark.parametrize("limit", [10**9, -1], ids=["broadcast", "shuffle"])
def test_a_batch_with_repeats_stores_its_messages_once(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr("brokerflow.plans.scratch.BROADCAST_BYTES", limit)
    stored, write = {}, landing.settle

    def settle(df, name):
        settled = write(df, name)
        stored[name] = settled.count()
        return settled

    monkeypatch.setattr(landing, "settle", settle)
    messages = log(spark, ["{}", "junk", '{"payload": {"a": 1}}'] + ["{}"] * 20)
    batch = Tables(spark, str(tmp_path)).begin(0)
    new, came = landing.new_messages(batch, messages.unionByName(messages.where("offset = 1")))
    assert (new.count(), new.select("kafka_offset").distinct().count(), came) == (23, 23, 24)
    assert stored["decoded"] == 24 and "new" not in stored
    assert stored["again"] == (1 if limit > 0 else 23)


def test_only_dead_messages_keep_their_text(spark):
    decoded = ev.decode(log(spark, ["junk", "{}", '{"payload": {"a": 1}}'])).orderBy("kafka_offset").collect()
    assert [r.text for r in decoded] == ["junk", "{}", None]


@pytest.mark.parametrize("text, is_object", [("{}", True), (" \t{\"a\": 1}\r\n", True), ("{a", False), ("a}", False), (" {}", False), ("{} ", True), (" {", False), ("", False), (None, None)])
def test_object_texts(spark, text, is_object):
    (row,) = spark.createDataFrame([(text,)], "t string").select(is_object_text(F.col("t")).alias("is")).collect()
    assert row["is"] is is_object


@pytest.mark.parametrize("limit", [10**9, -1], ids=["broadcast", "shuffle"])
def test_latest_rows_with_and_without_repeats(spark, monkeypatch, limit):
    monkeypatch.setattr("brokerflow.plans.scratch.BROADCAST_BYTES", limit)
    numbers = ["C1", "C2", "C1", None, None, "C3", "C3", "C3"]
    rows = spark.createDataFrame([claim(n, str(i), stg_id=f"s{i}") for i, n in enumerate(numbers)], CLAIM_SCHEMA)
    flagged = upsert.with_repeats(rows, ["claim_number"])
    want = sorted(star.claim_rows(rows).collect(), key=str)
    assert sorted(star.claim_rows(flagged).collect(), key=str) == want
    assert [r.claim_amount for r in want if r.claim_number == "C3"] == [7]
    if limit > 0:
        assert {r.claim_number for r in flagged.where(~F.col(upsert.REPEATED)).collect()} == {"C2"}


def test_cheap_rows_are_not_written_for_a_join(spark, monkeypatch, no_broadcast):
    written = []
    monkeypatch.setattr(joins, "settle", lambda df, name: written.append(name) or df)
    claims = spark.createDataFrame([("s1", "P1"), ("s2", "P9"), ("s3", None)], "stg_id string, policy_number string")
    policies = spark.createDataFrame([("P1", "k", "b", "c", "p")], "policy_number string, policy_key string, broker_key string, customer_key string, product_key string")
    joined = quality.with_policy(claims, policies, cheap=True)
    assert sorted((r.stg_id, r.policy_exists) for r in joined.collect()) == [("s1", True), ("s2", False), ("s3", False)]
    assert written == []


def test_landed_rows_are_signed_like_parsed_ones(spark, monkeypatch):
    """The rows that queries start from have the payload's map; it says the same as parsing the payload again."""
    texts = ["junk", "{}", '{"payload": null}', '{"payload": {}}', '{"payload": [1]}', '{"payload": "text"}',
             '{"payload": {"a": 1.50, "b": null, "c": {"d": 1}}}', '{"payload": {"a": 1, "a": 2}}']
    book = Book(spark, "")
    book.__dict__["messages"] = log(spark, texts)
    from brokerflow.operators.mapping import with_signature

    columns = ("kafka_offset", "payload_map", "header_signature")
    parsed = with_signature(ev.parse_envelopes(book.messages)).select(*columns)
    assert sorted(map(str, book.landed.select(*columns).collect())) == sorted(map(str, parsed.collect()))


def test_landed_places_are_not_compared_with_every_range(spark, tmp_path):
    """Offsets that do not touch are a range each; finding the landed ones among them takes one walk, no join by stretch."""
    spread = log(spark, ["{}"] * 200).withColumn("offset", F.col("offset") * 3)
    tables = Tables(spark, str(tmp_path))
    first = tables.begin(0)
    landing.keep_places(first, ev.decode(spread))
    first.commit()
    again = spread.where("offset < 30").unionByName(spread.withColumn("offset", F.col("offset") + 1)).unionByName(spread.where("offset = 0"))
    messages = again.unionByName(spread.limit(3).withColumn("offset", F.lit(None).cast("long")))
    found = landing._landed_before(tables.begin(1), messages)
    assert sorted(r.offset for r in found.collect()) == list(range(0, 30, 3))
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_a_range_over_several_stretches_is_found_in_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "STRETCH", 4)
    messages = log(spark, ["{}"] * 20)
    tables = Tables(spark, str(tmp_path))
    first = tables.begin(0)
    landing.keep_places(first, ev.decode(messages.where("offset BETWEEN 2 AND 15")))
    first.commit()
    found = landing._landed_before(tables.begin(1), messages)
    assert sorted(r.offset for r in found.collect()) == list(range(2, 16))


def test_a_log_is_written_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "MESSAGES_PER_FILE", 50)
    parts = [log(spark, ["{}"] * n) for n in (400, 30)]
    path, files = queries._write_log(parts, str(tmp_path / "log"))
    written = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert files == 8 and max(written) < 400 / 2 and sum(written) == 430


def test_claims_that_carry_a_column_are_not_joined_for_it(spark):
    names = spark.createDataFrame([("B", "b", "Beta")], "broker_key string, broker_code string, broker_name string")
    fact = spark.createDataFrame(
        [("c1", "p1", "B", "k1", "C1", "P1", "MOTOR", "Ann")],
        "claim_key string, policy_key string, broker_key string, customer_key string, claim_number string, policy_number string, product_line string, customer_name string",
    )
    none = spark.createDataFrame([], "policy_key string")  # has none of the columns, so that a lookup would fail
    seen = views.claims_view(views.Star(names, none, none, fact), ("claim_number", "policy_number", "broker_name", "product_line", "customer_name"))
    assert [tuple(r) for r in seen.collect()] == [("C1", "P1", "Beta", "Ann", "MOTOR")]


def test_rows_are_not_searched_for_unmapped_ones_where_every_layout_is_mapped(spark, tmp_path, monkeypatch):
    def searched(*_):
        raise AssertionError("searched")

    monkeypatch.setattr(mapping, "unmapped_rows", searched)
    tables = tables_after(spark, tmp_path, (0, [policy("P1")]))
    assert tables.read("waiting").count() == 0 and tables.keyed(POLICIES).count() == 1


def test_repeated_rows_alone_are_written_out(spark, monkeypatch):
    """What follows was computed for all rows twice, to keep the repeated ones of the second time."""
    written, settle = [], upsert.settle
    monkeypatch.setattr(upsert, "settle", lambda df, name: written.append(settle(df, name)) or written[-1])
    rows = spark.createDataFrame([("C1", 1), ("C1", 2), ("C2", 3), (None, 4)], "claim_number string, n int")
    apart = upsert.repeats_apart(rows, ["claim_number"])
    assert {(r.claim_number, r.n, r[upsert.REPEATED]) for r in apart.collect()} == {("C1", 1, True), ("C1", 2, True), ("C2", 3, False), (None, 4, False)}
    assert sorted(r.n for r in written[0].collect()) == [1, 2]
    whole = rows.withColumn("claim_number", F.coalesce("claim_number", F.lit("C3")))
    assert not upsert.repeats_apart(whole, ["claim_number"]).schema["claim_number"].nullable


def scratch_names(spark):
    """The names of all folders of stored intermediate tables."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch.shared_folder(spark)}/*/*")
    return [s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []]


def test_messages_are_not_held_beyond_staging(spark, tmp_path, monkeypatch):
    seen, promote = [], BatchRun.promote_policies
    monkeypatch.setattr(BatchRun, "promote_policies", lambda run, *a, **b: seen.append([n for n in scratch_names(spark) if n.startswith(("decoded-", "again-", "claims-"))]) or promote(run, *a, **b))
    before = set(scratch_names(spark))
    run_batch(spark, Tables(spark, str(tmp_path)), 0, log(spark, [policy("P1")]), AS_OF)
    assert [n.split("-")[0] for n in set(seen[0]) - before] == ["claims"]


def test_stored_tables_take_little_room(spark, tmp_path):
    """Stored tables are zstd files, and the shuffle files of a write don't outlive it."""
    stored = scratch.settle(spark.range(100).repartition(3, "id"), "small")
    assert all(".zstd.parquet" in f for f in stored.inputFiles())
    Tables(spark, str(tmp_path))._write(spark.range(10), "t/batch_id=0")
    assert list((tmp_path / "t").rglob("*.zstd.parquet")) and spark.conf.get(scratch.CLEANUP) == "true"


def test_raw_rows_are_stored_without_what_follows_from_them(spark):
    texts = ["junk", "{}", '{"payload": {}}', '{"payload": [1]}', '{"record_type": "claim", "payload": {"a": 1.50}}']
    book = Book(spark, "")
    messages = log(spark, texts)
    book.__dict__["messages"] = messages.unionByName(messages.where("offset = 4"))
    columns = ("raw_id", "broker_code", "record_type", "ingested_at", "payload_map", "header_signature")
    assert book.raw.columns == list(columns)
    assert sorted(map(str, book.raw.collect())) == sorted(map(str, book.landed.select(*columns).collect()))
    stored = spark.read.parquet(*[f for f in book.raw.inputFiles() if "/raw-" in f])
    assert not {"raw_id", "payload", "message_key"} & set(stored.columns)


def test_no_window_holds_a_whole_partition_of_the_log(spark, monkeypatch):
    """Two thousand offsets with gaps: ranges are put together by stretch, and across stretches only those at their ends."""
    sizes, islands = [], landing.islands

    def watched(ranges, by):
        sizes.append(max(r["count"] for r in ranges.groupBy(*by).count().collect()))
        return islands(ranges, by)

    monkeypatch.setattr(landing, "STRETCH", 64)
    monkeypatch.setattr(landing, "islands", watched)
    gaps = spark.range(0, 6000, 3).selectExpr("'t' AS topic", "0 AS partition", "id AS offset")
    held = landing.ranges_of(gaps)
    more = landing.with_places(held, gaps.withColumn("offset", F.col("offset") + 1))
    assert max(sizes) < 200 and held.count() == 2000
    assert sorted((r["first"], r["last"]) for r in more.collect()) == [(i, i + 1) for i in range(0, 6000, 3)]


def test_the_copy_a_log_is_written_from_is_deleted(spark):
    book, before = Book(spark, ""), set(scratch_names(spark))
    book.deliveries = lambda n: [scratch.settle(log(spark, ["{}"]).limit(0 if i else 1), "deliveries") for i in range(n)]
    path, files = queries._delivered_log(book)
    assert spark.read.parquet(path).count() == 1 and files == queries.FILES_PER_PART
    assert not [n for n in set(scratch_names(spark)) - before if n.startswith("deliveries-")]
