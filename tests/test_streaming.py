import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from textloom.operators import replay
from textloom.plans import catalog, stream_queries, usage_queries
from textloom.plans.usage_queries import LIMITS
from textloom.streaming import state, stateful


def test_admission_as_a_stream_is_that_of_the_batch(spark, sf_dir):
    streamed = {(r["id"], r["admitted"], r["reasons"]) for r in catalog.QUERIES["stream_admission"](spark, sf_dir).collect()}
    batch = replay.admission(usage_queries._calls(spark, sf_dir), ["user_id"], LIMITS)
    assert streamed == {(r["id"], r["admitted"], r["reasons"]) for r in batch.collect()}


def test_second_run_of_the_stub_does_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    asked = stream_queries.provided(docs.join(docs.select("doc_id"), "doc_id", "left_anti"), stream_queries.reversed_words, "text", "out")
    assert asked.count() == 0


def test_state_of_batches(spark, tmp_path):
    folder = str(tmp_path / "state")
    rows = lambda *r: spark.createDataFrame(list(r), "k string, n long, at int")
    read = lambda: sorted(map(tuple, state.load_state(spark, folder).collect()), key=str)
    assert state.load_state(spark, folder) is None
    state.save_state(rows(("a", 1, 1), ("b", 2, 2), (None, 3, 1)), ["k"], "at", folder, 0)
    for _ in range(2):  # a batch that is run again
        state.save_state(rows(("a", 9, 5), ("b", 8, 1), ("a", 7, 4)), ["k"], "at", folder, 1)
        assert read() == sorted([("a", 9, 5), ("b", 2, 2), (None, 3, 1)], key=str)
    state.save_state(rows(), ["k"], "at", folder, 2)
    assert len(read()) == 3
    with pytest.raises(ValueError):
        state.save_state(spark.range(3), ["id"], "id", folder, 3)


def files_of(folder, kind=""):
    return {p: p.stat().st_size for p in folder.rglob("*.parquet") if kind in str(p)}


def test_what_a_batch_writes_follows_the_batch(spark, tmp_path):
    """A large state, then small batches: deltas of their own size, merged bucket by bucket and not all at once."""
    root = tmp_path / "state"
    rng = random.Random(3)
    want = {k: (k, 0, f"value {k * 7919 % 100003}") for k in range(40_000)}
    frame = lambda r: spark.createDataFrame(r, "k long, at long, v string")
    state.save_state(frame(list(want.values())), ["k"], "at", str(root), 0)
    whole = sum(files_of(root).values())
    written, bases = [], 0
    for version in range(1, 9):
        batch = [(rng.randrange(45_000), version, f"new {version}") for _ in range(60)]
        before = files_of(root)
        state.save_state(frame(batch), ["k"], "at", str(root), version)
        if version == 3:  # run again after a failure
            state.save_state(frame(batch), ["k"], "at", str(root), version)
        written.append(sum(n for p, n in files_of(root).items() if p not in before))
        bases += any("-base" in str(p) for p in files_of(root) if p not in before)
        want |= {k: (k, at, v) for k, at, v in batch}
    assert max(written) < whole / 10, (written, whole)
    assert bases == 0
    got = {r["k"]: tuple(r) for r in state.load_state(spark, str(root)).collect()}
    assert got == want
    # A bucket whose deltas have grown to half its base is merged, and what it was read from goes after the next version.
    for version in (9, 10, 11):
        batch = [(k, version, f"x {version}") for k in range(25_000)]
        state.save_state(frame(batch), ["k"], "at", str(root), version)
        want |= {k: (k, at, v) for k, at, v in batch}
    assert files_of(root, "-base") and not files_of(root, "v000000003")
    assert {r["k"]: tuple(r) for r in state.load_state(spark, str(root)).collect()} == want
    assert {r["k"]: r["at"] for r in state.load_state(spark, str(root), 11).collect()}[1] == 10


def test_deltas_of_a_bucket_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "MOST_DELTAS", 3)
    frame = lambda r: spark.createDataFrame(r, "k long, at long")
    state.save_state(frame([(k, 0) for k in range(5000)]), ["k"], "at", str(tmp_path / "s"), 0, buckets=1)
    for version in range(1, 7):
        state.save_state(frame([(version, version)]), ["k"], "at", str(tmp_path / "s"), version)
        parts = state._manifest(state._Files(spark, str(tmp_path / "s")))["parts"]
        assert all(len(p) <= 4 for p in parts.values())
    assert sorted(r["at"] for r in state.load_state(spark, str(tmp_path / "s")).where("at > 0").collect()) == [1, 2, 3, 4, 5, 6]


def hourly_files(spark, folder, hours):
    """A file of 40 calls for each hour, out of order inside it, and last a row that only moves the watermark."""
    rng = random.Random(2)
    rows = []
    for h in range(hours):
        times = [h * 3600 + rng.randrange(3600) for _ in range(40)]
        rows += [(h, f"k{rng.randrange(5)}", h * 100 + i, datetime(2024, 1, 1) + timedelta(seconds=t), rng.randrange(30)) for i, t in enumerate(times)]
    rows.append((hours, None, None, datetime(2024, 1, 4), None))
    frame = spark.createDataFrame(rows, "h int, key string, id long, at timestamp, tokens long")
    for h in range(hours + 1):
        frame.where(f"h = {h}").drop("h").coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.02)  # files are taken in the order of their times
    return spark.readStream.schema(frame.drop("h").schema).option("maxFilesPerTrigger", 1).parquet(folder), [r[1:] for r in rows[:-1]]


def run_with_progress(spark, stream, folder):
    with stateful.rocksdb_state(spark):
        running = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out").collect(), [p["stateOperators"][0]["numRowsTotal"] for p in running.recentProgress if p["stateOperators"]]


def test_state_of_bursts_goes_with_the_watermark(spark, tmp_path):
    stream, rows = hourly_files(spark, str(tmp_path / "in"), 8)
    found, held = run_with_progress(spark, stateful.bursts(stream, "at", "key", "id", 300, 4, 3, late="10 minutes", blocks=2), str(tmp_path))
    want = set()
    for _, ident, at, _ in rows:
        here = [k for k, _, t, _ in rows if timedelta(0) <= at - t <= timedelta(seconds=300)]
        if len(here) >= 4 and len(set(here)) >= 3:
            want.add((ident, len(here), len(set(here))))
    assert len(want) > 10 and {tuple(r) for r in found} == want
    assert held[-1] <= 1 and max(held[1:-2]) < 60, held  # never more than what the watermark has not passed, of 320 events


def test_state_of_admission_goes_with_the_watermark(spark, tmp_path):
    stream, rows = hourly_files(spark, str(tmp_path / "in"), 8)
    limits = replay.Limits(rpm=2, tpm=60, rpd=25)
    found, held = run_with_progress(spark, stateful.admission(stream, ["key"], limits, "at", "id", "tokens", late="10 minutes"), str(tmp_path))
    calls = spark.createDataFrame([(k, i, at.timestamp(), n) for k, i, at, n in rows], "key string, id long, ts double, tokens long")
    batch = {(r["id"], r["admitted"], r["reasons"]) for r in replay.admission(calls, ["key"], limits).collect()}
    assert {(r["id"], r["admitted"], r["reasons"]) for r in found} == batch and len(batch) == 320
    assert 0 < sum(not a for _, a, _ in batch) < 320
    assert held[-1] == 0 and max(held) < 300, held


def test_many_keys_are_held_in_few_entries_of_state(spark, tmp_path):
    """Entries of state, each some round trips to the JVM, follow the buckets and not the keys; keys of a bucket stay apart."""
    rng = random.Random(5)
    rows = []
    for day in range(2):
        for i in range(1500):
            key = (f"k{rng.randrange(20)}", rng.choice(["m", "n", None]))
            rows.append((day, *key, day * 2000 + i, datetime(2024, 1, 1) + timedelta(hours=20 * day, seconds=rng.randrange(7200)), rng.randrange(60)))
    frame = spark.createDataFrame([*rows, (2, None, None, None, datetime(2024, 1, 5), None)], "d int, key string, model string, id long, at timestamp, tokens long")
    for day in range(3):
        frame.where(f"d = {day}").drop("d").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.02)
    stream = spark.readStream.schema(frame.drop("d").schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    limits = replay.Limits(rpm=2, tpm=90, rpd=30)
    found, held = run_with_progress(spark, stateful.admission(stream, ["key", "model"], limits, "at", "id", "tokens", buckets=2), str(tmp_path))
    calls = spark.createDataFrame([(k, m, i, at.timestamp(), n) for _, k, m, i, at, n in rows], "key string, model string, id long, ts double, tokens long")
    batch = {(r["key"], r["model"], r["id"], r["admitted"], r["reasons"]) for r in replay.admission(calls, ["key", "model"], limits).collect()}
    assert len(found) == 3000 and {tuple(r) for r in found} == batch
    assert {"rpm", "tpm", "rpd"} <= {x for r in batch for x in r[4].split(",")}
    assert held[-1] == 0 and 0 < max(held) <= 8, held  # waiting and granted lists of two buckets; 98 when every key had its own


def test_a_day_of_idling_frees_a_key(spark, tmp_path):
    """What is left of a key's usage after a day is nothing, also without further events of the key."""
    frame = spark.createDataFrame([("a", 1, datetime(2024, 1, 1, 1), 5), (None, None, datetime(2024, 1, 1, 2), None)], "key string, id long, at timestamp, tokens long")
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    time.sleep(0.02)
    frame.where("id is null").withColumn("at", F.expr("at + interval 3 days")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    found, held = run_with_progress(spark, stateful.admission(stream, ["key"], replay.Limits(rpd=1), "at", "id", "tokens"), str(tmp_path))
    assert [tuple(r) for r in found] == [("a", 1, True, "")] and held[-1] == 0


def test_a_provider_is_asked_for_a_bounded_amount_of_text_at_once(spark, monkeypatch):
    monkeypatch.setattr(stream_queries, "ASKED_CHARS", 10)
    sizes = lambda texts: [f"{len(texts)} {t}" for t in texts]
    rows = spark.createDataFrame([(0, None), (1, "abcdef"), (2, "abcdef"), (3, "x" * 50), (4, None), (5, "")], "i int, t string").coalesce(1)
    made = {r["i"]: r["out"] for r in stream_queries.provided(rows, sizes, "t", "out").collect()}
    assert made == {0: None, 1: "2 abcdef", 2: "2 abcdef", 3: "1 " + "x" * 50, 4: None, 5: "1 "}


def test_a_task_of_a_cascade_has_one_python_worker(spark):
    rows = spark.createDataFrame([(1, "a #b\n\n c d"), (2, ""), (3, None), (4, "#\n12 #x"), (5, "x\nx")], "i int, t string")
    hashes = lambda texts: [None if t == "#" else t.replace("#", "") + f"/{len(texts)}" for t in texts]
    zeros = lambda texts: [t.replace("1", "0") for t in texts]
    repairs = [(lambda c: c.contains("#"), hashes), (lambda c: c.rlike("[0-9]{2}"), zeros)]
    out = stream_queries.translated(rows.coalesce(1), ["i"], "t", stream_queries.reversed_words, repairs, most=0)
    assert "MapInArrow" not in out._jdf.queryExecution().optimizedPlan().toString()
    # A repair that gives nothing back leaves its chunk, and it was asked for the three chunks with a # only.
    assert {r["i"]: r["translated"] for r in out.collect()} == {1: "b a/3\nd c", 2: "", 3: "", 4: "#\nx 02/3", 5: "x\nx"}
