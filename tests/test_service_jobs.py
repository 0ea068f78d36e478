"""Answer ledger (distinct texts, runs that go on after a kill) and parallel batching."""
import json
import os
import random
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import batching as B
from tessera.operators import ledger as L
from tessera.session import scratch_path


def service(folder, fail=lambda texts: False, die_after=None):
    """A translator that notes every text it is sent in a file of its own; `die_after` calls the executor's
    task fails for good, as if the job were killed."""
    def call(pdf: pd.DataFrame) -> pd.Series:
        out = []
        for items in pdf["items"]:
            texts = [i["text"] for i in items]
            if die_after is not None and len(os.listdir(folder)) >= die_after:
                raise SystemExit("killed")
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                json.dump(texts, f)
            if fail(texts):
                raise RuntimeError("service unavailable")
            out.append(json.dumps([{"translations": [{"text": "en:" + t, "to": "en"}]} for t in texts]))
        return pd.Series(out)
    return call


def sent(folder):
    return sorted(t for n in os.listdir(folder) for t in json.load(open(os.path.join(folder, n))))


ROWS = [(1, "eins", "a"), (2, "zwei", "eins"), (2, "zwei", None), (None, "drei", "b"), (4, None, None), (5, "", "a"), (6, "zwei", "eins")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id long, title string, body string")


def translated(spark, ledger, call, rows=ROWS, **more):
    out = L.translate_resumable(frame(spark, rows), ["title", "body"], call, ledger, **more)
    return sorted((tuple(r) for r in out.select("id", "title", "body", "title_en", "body_en", "title_error", "body_error").collect()), key=str)


def wanted(rows=ROWS):
    en = lambda t: None if t is None else "en:" + t
    return sorted(((i, t, b, en(t), en(b), None, None) for i, t, b in rows), key=str)


def test_a_text_is_sent_once(spark, tmp_path):
    ledger = L.Ledger(spark, scratch_path(spark, f"ledger-{uuid.uuid4().hex}"))
    assert translated(spark, ledger, service(str(tmp_path))) == wanted()
    assert sent(tmp_path) == ["", "a", "b", "drei", "eins", "zwei"]
    more = ROWS + [(9, "neun", "zwei")]
    assert translated(spark, ledger, service(str(tmp_path)), more) == wanted(more)
    assert sent(tmp_path) == ["", "a", "b", "drei", "eins", "neun", "zwei"]


def test_a_killed_run_goes_on(spark, tmp_path):
    """After a kill no text that the ledger answers is sent again."""
    rows = [(i, f"text {i}", None) for i in range(60)]
    ledger = L.Ledger(spark, scratch_path(spark, f"ledger-{uuid.uuid4().hex}"))
    with pytest.raises(Exception):
        translated(spark, ledger, service(str(tmp_path), die_after=12), rows, max_items=1, wave=10)
    answered = {r.answer for r in ledger.answers().collect()}
    before = sent(tmp_path)
    assert 0 < len(answered) < 60
    assert translated(spark, ledger, service(str(tmp_path)), rows, max_items=1, wave=10) == wanted(rows)
    again = list(sent(tmp_path))
    for t in before:
        again.remove(t)
    assert not {"en:" + t for t in again} & answered and len(answered) + len(again) == 60
    done = len(os.listdir(tmp_path))
    assert translated(spark, ledger, service(str(tmp_path)), rows) == wanted(rows) and len(os.listdir(tmp_path)) == done


def test_failed_requests_stay_open(spark, tmp_path):
    ledger = L.Ledger(spark, scratch_path(spark, f"ledger-{uuid.uuid4().hex}"))
    got = translated(spark, ledger, service(str(tmp_path), fail=lambda ts: "zwei" in ts), max_items=1, retries=2)
    by = {r[1]: r for r in got}
    assert by["zwei"][3] is None and by["zwei"][5] == "RuntimeError: service unavailable" and by["eins"][3] == "en:eins"
    assert sent(tmp_path).count("zwei") == 2
    assert translated(spark, ledger, service(str(tmp_path))) == wanted()


def test_short_and_malformed_answers_are_failures(spark):
    ledger = L.Ledger(spark, scratch_path(spark, f"ledger-{uuid.uuid4().hex}"))
    one = lambda pdf: pd.Series([json.dumps([{"translations": [{"text": "only", "to": "en"}]}]) for _ in range(len(pdf))])
    failed = L.answer_missing(frame(spark, [(1, "a", "b"), (2, "c", None)]), ["title", "body"], one, ledger, parse=L.translations)
    rows = failed.collect()
    assert len(rows) + ledger.answers().count() == 3 and {r.error for r in rows} == {"no answer for this text"}
    bad = L.answer_missing(frame(spark, [(1, "x", None)]), ["title"], lambda pdf: pd.Series(["oops"] * len(pdf)), ledger, parse=L.translations)
    assert [r.error for r in bad.collect()] == ["no answer for this text"]


def test_answers_are_stored_once_and_texts_stay_where_they_are(spark, tmp_path, monkeypatch):
    """Answers are written to the ledger only, and the joins move the keys of a row, not its texts, with the
    column that has the most text joined last."""
    stored, store = [], L.materialize
    monkeypatch.setattr(L, "materialize", lambda df: stored.append(df.columns) or store(df))
    ledger = L.Ledger(spark, scratch_path(spark, f"ledger-{uuid.uuid4().hex}"))
    rows = [(i, f"a long text of row {i}" if i % 7 else None, "xy"[i % 2]) for i in range(40)] + [(1, "zwei", None)]
    df = frame(spark, rows).withColumn("title_key", F.col("id"))
    out = L.translate_resumable(df, ["title", "body"], service(str(tmp_path), fail=lambda ts: "zwei" in ts), ledger, max_items=1, retries=1)
    assert stored and not [c for c in stored if "answer" in c] and out.columns == df.columns + ["title_en", "title_error", "body_en", "body_error"]
    got = sorted(((r.id, r.title_key, r.title_en, r.title_error, r.body_en, r.body_error) for r in out.collect()), key=str)
    en = lambda t: None if t in (None, "zwei") else "en:" + t
    down = "RuntimeError: service unavailable"
    assert got == sorted(((i, i, en(t), down if t == "zwei" else None, en(b), None) for i, t, b in rows), key=str)
    plan = out.select("id", "title_en", "body_en")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    moved = [x.split("Project [")[1].rsplit("]", 1)[0] for x in plan if "sha2(cast(title" in x]
    assert moved and not [x for x in moved for c in x.split(", ") if c.startswith(("title#", "body#"))]
    first = {c: next(i for i, x in enumerate(plan) if f"AS {c}" in x) for c in ("title_en", "body_en")}
    assert first["body_en"] < first["title_en"] and not [x for x in plan if "Union" in x]
    again = L.translate_resumable(df.drop("title_key"), ["title", "body"], service(str(tmp_path)), ledger, keys=True)
    assert {r.title: r.title_key for r in again.collect()} == {r.title: r.k for r in again.select("title", L.text_key("title").alias("k")).collect()}
    assert again.filter("title_error is not null or title_en is null and title is not null").count() == 0


def test_ledgers_without_failures_are_read(spark):
    """A ledger of (key, answer), as runs wrote it before failures were noted in it."""
    path = scratch_path(spark, f"ledger-{uuid.uuid4().hex}")
    key = spark.range(1).select(F.lit("eins").alias("t")).select(L.text_key("t").alias("key"), F.lit("one").alias("answer"))
    key.write.parquet(path)
    ledger = L.Ledger(spark, path)
    assert [r.answer for r in ledger.answers().collect()] == ["one"] and ledger.failures("x").count() == 0


def test_nothing_to_send(spark, tmp_path):
    ledger = L.Ledger(spark, scratch_path(spark, f"ledger-{uuid.uuid4().hex}"))
    assert translated(spark, ledger, service(str(tmp_path)), [(1, None, None)]) == wanted([(1, None, None)])
    assert translated(spark, ledger, service(str(tmp_path)), []) == [] and sent(tmp_path) == []


def test_waits_grow(monkeypatch):
    waits = []
    monkeypatch.setattr(B.time, "sleep", waits.append)
    run = {}

    class Frame:
        schema = B.T.StructType([])

        def mapInPandas(self, fn, schema):
            run["fn"] = fn

    def fail(_):
        raise TimeoutError("later")
    B.score_batches(Frame(), fail, retries=5, wait_seconds=2.0, most_wait=10.0)
    out = list(run["fn"](iter([pd.DataFrame({"items": [1]})])))[0]
    assert waits == [2.0, 4.0, 8.0, 10.0] and out["attempts"][0] == 5 and out["error"][0] == "TimeoutError: later"


def test_answers_leave_a_worker_in_small_frames():
    """However many requests Spark hands over at once, few are held answered, and the frame before is gone
    when the next is made."""
    import gc
    import weakref
    run, alive = {}, []

    class Frame:
        schema = B.T.StructType([])

        def mapInPandas(self, fn, schema):
            run["fn"] = fn

    def frames():
        for n in (1000, 0, 1, 333):
            gc.collect()
            assert not [1 for r in alive if r() is not None]
            pdf = pd.DataFrame({"items": [[i, n] for i in range(n)]}, index=range(5, 5 + n))
            alive.append(weakref.ref(pdf))
            yield pdf
            del pdf
    B.score_batches(Frame(), lambda pdf: pd.Series([json.dumps(pdf["items"].iloc[0])]))
    out, largest = [], 0
    for f in run["fn"](frames()):
        assert list(f.columns) == ["items", "answer", "error", "attempts"]
        out += [(i, json.loads(a), e, n) for i, a, e, n in f.itertuples(index=False)]
        largest = max(largest, len(f))
    assert out == [([i, n], [i, n], None, 1) for n in (1000, 0, 1, 333) for i in range(n)] and largest <= B.ANSWERS_A_FRAME


# --- batching in parallel -----------------------------------------------------------------

def plain(lengths, max_items, max_chars):
    out, batch, items, chars = [], -1, 0, 0
    for n in lengths:
        if batch < 0 or items + 1 > max_items or chars + n > max_chars:
            batch, items, chars = batch + 1, 0, 0
        items, chars = items + 1, chars + n
        out.append(batch)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_jump_tables_equal_the_scan(seed):
    """Blocks entered in turn give the batches of one scan, for any cut into blocks."""
    rng = random.Random(seed)
    for _ in range(30):
        items, chars = rng.randrange(1, 9), rng.choice([5, 20, 1000])
        own = rng.randrange(2 * items, 4 * items + 3)
        lengths = np.array([rng.choice([0, 1, 3, chars, chars + 5, rng.randrange(chars)]) for _ in range(rng.randrange(1, 120))])
        blocks = [lengths[i:i + own + items] for i in range(0, len(lengths), own)]
        tables = [B.jump_table(b, min(own, len(lengths) - i * own), items, items, chars) for i, b in enumerate(blocks)]
        at, total = 0, 0
        scan = plain(lengths, items, chars)
        for i, (exits, counts) in enumerate(tables):
            mine = [j for j in range(i * own, min((i + 1) * own, len(lengths))) if j == 0 or scan[j] != scan[j - 1]]
            assert counts[at] == len(mine) and (not mine or mine[0] == i * own + at)
            at, total = int(exits[at]), total + int(counts[at])
        whole = B.compose(tables)
        assert total == scan[-1] + 1 == whole[1][0] and at == whole[0][0]


@pytest.mark.parametrize("ids", ["long", "string"])
def test_parallel_batches_equal_the_scan(spark, ids):
    rng = random.Random(7)
    rows = [(i * 3 if ids == "long" else f"id{i}", "x" * rng.choice([0, 1, 5, 30, 90, 250])) for i in range(2000)]
    rows += [(None, "abc"), (7 if ids == "long" else "n", None)]
    df = spark.createDataFrame(rows, f"id {ids}, text string")
    one = {(r.id, r.shard, r.batch, r.n_chars) for r in B.greedy_batches(df, "id", "text", 10, 200, shards=2).collect()}
    two = {(r.id, r.shard, r.batch, r.n_chars) for r in
           B.greedy_batches_blocks(df, "id", "text", 10, 200, shards=2, rows_a_block=40, blocks_a_group=5).collect()}
    assert len(one) == 2001 and one == two


def test_parallel_batches_of_nothing(spark):
    assert B.greedy_batches_blocks(spark.createDataFrame([], "id long, text string"), "id", "text").count() == 0
