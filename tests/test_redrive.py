"""Dead letters tried again: repaired once, waiting longer each time, given up; rejected documents of an index."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.envelope import to_envelope
from tidemark.schemas import TOPIC_RECORD
from tidemark.sources.versioned import envelope_table
from tidemark.streaming import redrive as R


class Died(Exception):
    pass


def _store(spark):
    rows = [("prices_raw", 0, i, i, json.dumps({"symbol": "S", "closing_price": i, "timestamp": "2024-01-02"})) for i in range(5)]
    rows += [("prices_raw", 0, i, i, f"broken {i}") for i in range(5, 9)]
    env = to_envelope(spark.createDataFrame(rows, TOPIC_RECORD), "2024-01-01T00:00:00", keep_dead_letters=True)
    table = envelope_table(spark, tempfile.mkdtemp() + "/t")
    table.append(env.withColumns({"doc_type": F.col("data.type"), "event_date": F.substring("timestamp", 1, 10)}))
    return table


def _mend(*which):
    good = [f"broken {i}" for i in which]
    return lambda v: F.when(v.isin(good), F.concat(F.lit('{"symbol": "R", "closing_price": '), F.substring(v, 8, 3), F.lit("}"))).otherwise(v)


def _kinds(table):
    return sorted((r["kafka_offset"], r["doc_type"]) for r in table.read().collect())


def test_a_repaired_record_leaves_and_arrives_once(spark):
    table = _store(spark)
    first = R.redrive_dead_letters(table, _mend(5), "r", 0, now=100.0, backoff_s=10, max_attempts=3, ingest_ts="2024-01-01T00:00:00")
    assert first == {"tried": 4, "repaired": 1, "waiting": 3, "given_up": 0}
    assert R.redrive_dead_letters(table, _mend(5, 6), "r", 0, now=500.0) is None                   # the batch again
    want = [(i, "price") for i in range(6)] + [(i, "dead_letter") for i in (6, 7, 8)]
    assert _kinds(table) == want
    assert R.redrive_dead_letters(table, _mend(6), "r", 1, now=105.0)["tried"] == 0                # not due yet
    assert R.redrive_dead_letters(table, _mend(6), "r", 2, now=110.0, backoff_s=10, max_attempts=3) == {
        "tried": 3, "repaired": 1, "waiting": 2, "given_up": 0}
    assert {r["due_at"] for r in table.read_side(table.state(), "redrive r", R.TRIES).collect()} == {130.0}
    last = R.redrive_dead_letters(table, _mend(), "r", 3, now=200.0, backoff_s=10, max_attempts=3)
    assert last == {"tried": 2, "repaired": 0, "waiting": 0, "given_up": 2}
    assert R.redrive_dead_letters(table, _mend(7), "r", 4, now=9999.0)["tried"] == 0
    assert _kinds(table) == [(i, "price") for i in range(7)] + [(i, "dead_letter") for i in (7, 8)]
    row = table.read().where("kafka_offset = 5").first()
    assert row["symbol"] == "R" and row["data"]["closing_price"] == 5.0 and row["kafka_timestamp_ms"] == 5


@pytest.mark.parametrize("step", ["side", "written", "prepared", "committed"])
def test_a_redrive_that_dies(spark, step):
    table = _store(spark)
    before = _kinds(table)

    def at(name):
        if name == step:
            raise Died
    table.on_step = at
    with pytest.raises(Died):
        R.redrive_dead_letters(table, _mend(5, 7), "r", 0, now=1.0)
    other = envelope_table(spark, table.path)
    after = [(i, "price") if i in (5, 7) else (i, k) for i, k in before]
    assert _kinds(other) == (after if step == "committed" else before)
    R.redrive_dead_letters(other, _mend(5, 7), "r", 0, now=1.0)
    assert _kinds(other) == after


def test_without_dead_letters(spark):
    table = _store(spark)
    R.redrive_dead_letters(table, _mend(5, 6, 7, 8), "r", 0, now=1.0)
    assert R.redrive_dead_letters(table, _mend(), "r", 1, now=9.0) == {"tried": 0, "repaired": 0, "waiting": 0, "given_up": 0}
    empty = envelope_table(spark, tempfile.mkdtemp() + "/t")
    assert R.redrive_dead_letters(empty, _mend(), "r", 0, now=9.0)["tried"] == 0


def _index(folder, broken):
    """A client of an index kept in files by id: documents whose value is in ``broken`` are rejected, ``boom`` fails the bulk."""
    def send(docs):
        import json as j
        import os
        if any(d["v"] == "boom" for d in docs):
            raise OSError("no connection")
        out = []
        for d in docs:
            if d["v"] in broken:
                out.append("rejected")
            else:
                with open(f"{folder}/{d['id']}", "w") as f:
                    j.dump(d, f)
                out.append(None)
        return out
    return send


def test_rejected_documents_come_to_the_index_later(spark, tmp_path):
    import os
    schema = T.StructType().add("id", T.StringType()).add("v", T.StringType())
    dead = R.dead_documents(spark, tempfile.mkdtemp() + "/dead", schema)
    docs = spark.createDataFrame([(f"d{i}", f"v{i}") for i in range(10)], schema).repartition(2)
    folder = str(tmp_path)
    assert R.index_batch(dead, docs, _index(folder, ["v3", "v5"]), "ship", 0, now=0.0, backoff_s=10, max_attempts=2) == 1
    assert R.index_batch(dead, docs, _index(folder, []), "ship", 0, now=0.0) is None
    assert len(os.listdir(folder)) == 8 and dead.read().count() == 2
    assert {r["error"] for r in dead.read().collect()} == {"rejected"}
    assert R.redrive_index(dead, _index(folder, []), "again", 0, now=5.0) == {"tried": 0, "accepted": 0}
    assert R.redrive_index(dead, _index(folder, ["v5"]), "again", 1, now=10.0, backoff_s=10, max_attempts=2) == {"tried": 2, "accepted": 1}
    assert R.redrive_index(dead, _index(folder, []), "again", 1, now=99.0) is None
    assert sorted(os.listdir(folder)) == sorted(f"d{i}" for i in range(10) if i != 5)
    left = dead.read().collect()
    assert [(r["id"], r["attempts"], r["given_up"]) for r in left] == [("d5", 2, "true")]
    assert R.redrive_index(dead, _index(folder, []), "again", 2, now=999.0)["tried"] == 0


def test_a_bulk_that_fails_is_tried_again_as_a_whole(spark, tmp_path):
    import os
    schema = T.StructType().add("id", T.StringType()).add("v", T.StringType())
    dead = R.dead_documents(spark, tempfile.mkdtemp() + "/dead", schema)
    docs = spark.createDataFrame([("a", "boom"), ("b", "x"), ("c", "y")], schema).coalesce(1)
    R.index_batch(dead, docs, _index(str(tmp_path), []), "ship", 0, now=0.0, bulk=2)
    assert os.listdir(tmp_path) == ["c"]
    assert {r["error"] for r in dead.read().collect()} == {"OSError: no connection"}
