"""Store updates that die at every step, the scoring loop's polls and retries, compaction of partial sums."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators.envelope import to_envelope
from tidemark.operators.scoring import RETRY, Scorer, score_updates, scoring_poll, update_store
from tidemark.schemas import TOPIC_RECORD
from tidemark.sources.versioned import envelope_table
from tidemark.streaming import jobs as P


class Died(Exception):
    pass


def _docs(spark, rows):
    recs = spark.createDataFrame([(t, 0, i, 1_700_000_000_000 + i, v) for i, t, v in rows], TOPIC_RECORD)
    env = to_envelope(recs, "2024-01-05T00:00:00", keep_dead_letters=True)
    return env.withColumns({"doc_type": F.col("data.type"), "event_date": F.substring("timestamp", 1, 10)})


def _text(i, text, day=1):
    return i, "twitter_raw", json.dumps({"id": str(i), "company": "c", "text": text, "timestamp": f"2024-01-0{day}T00:00:00"})


def _store(spark, path=None):
    table = envelope_table(spark, path or tempfile.mkdtemp() + "/store")
    if path is None:
        rows = [_text(i, None if i % 7 == 0 else f"u shares tumble {i}", 1 + i % 3) for i in range(30)]
        rows += [(i, "prices_raw", json.dumps({"symbol": "S", "closing_price": i, "timestamp": "2024-01-01"})) for i in range(30, 40)]
        rows += [(40, "twitter_raw", "no json")]
        table.append(_docs(spark, rows), writer="ingest", batch=0)
    return table


def _seen(table):
    rows = table.read().select("kafka_offset", "doc_type", "data.sentiment_label", "data.original_text").collect()
    return sorted(map(tuple, rows))


@pytest.mark.parametrize("step", ["written", "prepared", "committed"])
def test_an_update_that_dies_loses_no_document_and_shows_no_mixed_state(spark, step):
    table = _store(spark)
    before = _seen(table)

    def at(name):
        if name == step:
            raise Died
    table.on_step = at
    with pytest.raises(Died):
        update_store(table, score_updates(table.read(), "now"), writer="q", batch=0)
    other = _store(spark, table.path)
    assert (_seen(other) == before) == (step != "committed")
    update_store(other, score_updates(other.read(version=1), "now"), writer="q", batch=0)
    after = _seen(other)
    assert [r[0] for r in after] == list(range(41))
    assert [r[0] for r in after if r[1] == "sentiment"] == [i for i in range(30) if i % 7]
    assert all(r[2] == "NEGATIVE" and r[3] for r in after if r[1] == "sentiment")


def test_an_update_rewrites_only_folders_of_its_documents(spark):
    table = _store(spark)
    old = table.state().folders
    updates = score_updates(table.read().where("event_date = '2024-01-02'"), "now")
    update_store(table, updates)
    new = table.state().folders
    gone = {f.split("/", 1)[1] for f in old if f not in new}
    assert gone == {"doc_type=twitter_raw/event_date=2024-01-02"}
    again = update_store(table, updates.withColumn("sentiment_label", F.lit("POSITIVE")).withColumn("processed_at", F.lit("z")))
    assert again and table.read().where("data.sentiment_label = 'POSITIVE'").count() == updates.count()
    assert table.read().count() == 41


def test_two_updates_of_one_version_meet(spark):
    a = _store(spark)
    b = envelope_table(spark, a.path)
    updates = score_updates(a.read(), "now")
    # b commits while a's data is written: a finds its folders gone and updates b's version
    done = []

    def at(name):
        if name == "written" and not done:
            done.append(1)
            update_store(b, updates.withColumn("processed_at", F.lit("later")).where("kafka_offset % 2 = 0"))
    a.on_step = at
    update_store(a, updates)
    rows = a.read().where("doc_type = 'sentiment'").select("kafka_offset").collect()
    assert sorted(r[0] for r in rows) == [i for i in range(30) if i % 7] and a.read().count() == 41


def test_the_second_poll_scores_nothing_and_new_documents_are_found(spark):
    table = _store(spark)
    first = scoring_poll(table, "q", 0, processed_at="p")
    assert (first["scored"], first["failed"]) == (25, 0)
    assert scoring_poll(table, "q", 0) is None                      # the batch again
    second = scoring_poll(table, "q", 1)
    assert (second["scored"], second["failed"], second["waiting"]) == (0, 0, 0)
    table.append(_docs(spark, [_text(50, "record day"), _text(51, None)]), writer="ingest", batch=1)
    third = scoring_poll(table, "q", 2)
    assert third["scored"] == 1 and scoring_poll(table, "q", 3)["scored"] == 0
    got = {r[0]: r[2] for r in _seen(table)}
    assert got[50] == "POSITIVE" and got[51] is None and got[1] == "NEGATIVE" and got[7] is None


def _fragile(bad):
    class Fragile(Scorer):
        def __init__(self, bad):
            self.bad = bad

        def score(self, texts):
            if any(b in t for t in texts for b in self.bad):
                raise ValueError("cannot read this")
            return texts.map(lambda t: "NEUTRAL"), texts.map(lambda t: 0.0)
    return Fragile(bad)


def test_failed_documents_wait_come_back_and_are_given_up(spark):
    table = _store(spark)
    bad = [" 3", " 5"]          # of offsets 3, 5
    first = scoring_poll(table, "q", 0, _fragile(["tumble 3", "tumble 5"]), now=1000.0, backoff_s=60, max_attempts=3)
    n_bad = sum(any(f"tumble {i}".startswith("tumble" + b) for b in bad) for i in range(30) if i % 7)
    assert (first["scored"], first["failed"], first["waiting"]) == (25 - n_bad, n_bad, n_bad)
    state = {r["kafka_offset"]: r for r in table.read_side(table.state(), "retry q", RETRY).collect()}
    assert state[3]["due_at"] == 1060.0 and state[3]["attempts"] == 1 and "cannot read this" in state[3]["error"]
    assert scoring_poll(table, "q", 1, _fragile(["tumble 3", "tumble 5"]), now=1059.0)["failed"] == 0       # not due yet
    second = scoring_poll(table, "q", 2, _fragile(["tumble 5"]), now=1060.0, backoff_s=60, max_attempts=3)
    assert (second["scored"], second["failed"]) == (n_bad - 1, 1)
    assert [r["due_at"] for r in table.read_side(table.state(), "retry q", RETRY).collect()] == [1180.0]
    third = scoring_poll(table, "q", 3, _fragile(["tumble 5"]), now=2000.0, backoff_s=60, max_attempts=3)
    assert (third["failed"], third["waiting"], third["given_up"]) == (1, 0, 1)
    assert scoring_poll(table, "q", 4, _fragile([]), now=9000.0)["scored"] == 0
    assert sorted(r[0] for r in _seen(table)) == list(range(41))


def test_a_poll_that_dies_is_made_again(spark):
    table = _store(spark)

    def at(name):
        if name == "prepared":
            table.on_step = lambda name: None
            raise Died
    table.on_step = at
    waited = []
    done = P.patiently(lambda: scoring_poll(table, "q", 0, processed_at="p"), 3, 60.0, waited.append)
    assert done["scored"] == 25 and waited == [60.0] and scoring_poll(table, "q", 1)["scored"] == 0
    with pytest.raises(Died):
        P.patiently(lambda: (_ for _ in ()).throw(Died()), 2, 1.0, waited.append)


def test_the_loop_as_a_stream_of_polls(spark):
    table = _store(spark)
    ck = tempfile.mkdtemp() + "/ck"
    for _ in range(2):
        P.start_scoring_loop(spark, table.path, ck, available_now=True, processed_at="p")
    polls = [e["mark"] for e in table.history() if e["mark"] and "scored" in e["mark"]]
    assert [p["scored"] for p in polls] == [25, 0] and [p["batch"] for p in polls] == [0, 1]


def _partials(spark, k):
    return spark.createDataFrame([(f"c{i % 3}", f"d{(i + k) % 4}", float(i + k), 1, 2, 1, "0") for i in range(6)], P.PARTIALS)


def test_compaction_keeps_sums_and_bounds_folders(spark):
    table = P.partials_table(spark, tempfile.mkdtemp() + "/p")
    want = None
    for k in range(20):
        rows = _partials(spark, k)
        assert table.append(rows, "q", k) and table.append(rows, "q", k) is None       # a replay adds nothing
        want = rows if want is None else want.unionByName(rows)
        P.compact_partials(table, fan_in=3)
        assert len(table.state().folders) <= 2 * 4
        if k == 10:
            pinned, then = table.read(), P.merge_sentiment_partials(want)
    got = P.read_daily_sentiment(spark, table.path)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, P.merge_sentiment_partials(want).collect()))
    assert sorted(map(tuple, P.merge_sentiment_partials(pinned).collect())) == sorted(map(tuple, then.collect()))
    # each company and day comes at most once a folder
    assert table.read().count() <= 12 * len(table.state().folders)


@pytest.mark.parametrize("step", ["written", "prepared", "committed"])
def test_compaction_that_dies_counts_nothing_twice(spark, step):
    table = P.partials_table(spark, tempfile.mkdtemp() + "/p")
    for k in range(3):
        table.append(_partials(spark, k), "q", k)
    before = sorted(map(tuple, P.read_daily_sentiment(spark, table.path).collect()))

    def at(name):
        if name == step:
            raise Died
    table.on_step = at
    with pytest.raises(Died):
        P.compact_partials(table, fan_in=3)
    assert sorted(map(tuple, P.read_daily_sentiment(spark, table.path).collect())) == before
    other = P.partials_table(spark, table.path)
    P.compact_partials(other, fan_in=3)
    assert sorted(map(tuple, P.read_daily_sentiment(spark, table.path).collect())) == before
    assert len(other.state().folders) == 1
