"""Batching, parsing and un-batching (synthetic cases of FIXTURES.md section 6)."""
import json
import re
from functools import partial

import pandas as pd
from pyspark.sql import functions as F

from tessera.operators import batching as B


def _greedy(spark, lengths):
    df = spark.createDataFrame([(i, "x" * n) for i, n in enumerate(lengths)], "id long, text string")
    out = B.greedy_batches(df, "id", "text", shards=1).orderBy("id").collect()
    sizes = {}
    for r in out:
        sizes[r.batch] = sizes.get(r.batch, 0) + 1
    return [sizes[b] for b in sorted(sizes)]


def test_greedy_char_limit(spark):
    assert _greedy(spark, [44999, 1, 1]) == [2, 1]


def test_greedy_oversized_first(spark):
    assert _greedy(spark, [50000, 10]) == [1, 1]


def test_greedy_item_limit(spark):
    assert _greedy(spark, [1] * 901) == [900, 1]


def test_greedy_independent_of_arrow_batch_size(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        assert _greedy(spark, [1] * 901) == [900, 1]
        assert _greedy(spark, [30000, 20000, 10, 44990]) == [1, 2, 1]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_chunk_unbatch_identity(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(57)], "id long, text string")
    p = B.batch_prompts(B.chunk(df, "id", 20, shards=2), "id", "text", "score:\n")
    answers = p.withColumn("answer", F.to_json(F.transform("items", lambda x: x["id"].cast("double"))))
    ok, rej = B.check_answers(answers)
    assert rej.count() == 0
    back = B.unbatch(ok).collect()
    assert sorted((r.id, r.score) for r in back) == [(i, float(i)) for i in range(57)]
    assert max(r.n_items for r in p.collect()) == 20


def test_parse_cases(spark):
    df = spark.createDataFrame([("[0, 0.5, null, 1.0]",), (None,), ("sorry",)], "a string")
    got = [r.s for r in df.select(B.parse_scores(F.col("a")).alias("s")).collect()]
    assert got == [[0.0, 0.5, None, 1.0], None, None]


def test_reject_reasons(spark):
    items = [{"pos": 0, "id": 1, "text": "a"}, {"pos": 1, "id": 2, "text": "b"}]
    df = spark.createDataFrame([(0, 0, items, 2, "[0.1]"), (0, 1, items, 2, "oops"), (0, 2, items, 2, None)],
                               "shard int, batch int, items array<struct<pos:int,id:long,text:string>>, "
                               "n_items int, answer string")
    ok, rej = B.check_answers(df)
    assert sorted((r.batch, r.reason) for r in rej.collect()) == [(0, "length"), (1, "malformed")]
    assert [r.score for r in B.unbatch(ok).collect()] == [None, None]


def test_flaky_scorer_retries(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(40)], "id long, text string")
    p = B.batch_prompts(B.chunk(df, "id", 20, shards=1), "id", "text", "score:\n")
    state = {"n": 0}

    def flaky(pdf: pd.DataFrame) -> pd.Series:
        state["n"] += 1
        if state["n"] % 3 != 0:
            raise TimeoutError("slow")
        return pd.Series([json.dumps([0.0] * len(pdf["items"].iloc[0]))])

    out = B.score_batches(p.coalesce(1), flaky, retries=3).collect()
    assert all(r.answer is not None and r.error is None and r.attempts == 3 for r in out)

    def down(pdf):
        raise RuntimeError("down")

    bad = B.score_batches(p, down, retries=2).collect()
    assert all(r.answer is None and "down" in r.error and r.attempts == 2 for r in bad)


def test_scored_batches_are_dealt_to_as_many_tasks_as_the_shuffle_has(spark):
    """The registered job has no number of tasks of its own, so that a task's share does not grow with the texts."""
    import __spark_entry__ as E
    from conftest import SF_SMALL
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "23"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        assert E.queries()["score_batches_retry"](spark, SF_SMALL).rdd.getNumPartitions() == 23
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rank_in_shard_matches_global_order(spark):
    ids = [7, 3, 11, 2, 40, 41, 5, 100, 64, 63, 9, 8]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r.id: (r.shard, r._rn) for r in B.rank_in_shard(df, "id", 2, rows_a_bucket=1).collect()}
    for sh in (0, 1):
        members = sorted(i for i in ids if i % 2 == sh)
        assert [got[i] for i in members] == [(sh, k) for k in range(len(members))]


def test_far_and_crowded_ids_are_dealt_evenly(spark, monkeypatch):
    """One far id does not put all others in one bucket, hence one task; positions stay exact, also where buckets are
    cut again and where no table is broadcast."""
    crowded = [*range(2000), *(10**9 + 7 * i for i in range(1000)), -5, 2**62]
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "97"}
    before = {k: spark.conf.get(k) for k in keys}
    df = spark.createDataFrame([(i,) for i in crowded], "id long").repartition(3)
    want = {i: (s, k) for s in (0, 1) for k, i in enumerate(sorted(i for i in crowded if i % 2 == s))}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        ranked = B.rank_in_shard(df, "id", 2, rows_a_bucket=50)
        assert {r.id: (r.shard, r._rn) for r in ranked.collect()} == want
        assert max(r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()) < 300
        monkeypatch.setattr(B, "MARKS", 8)
        again = B.rank_in_shard(df, "id", 2, rows_a_bucket=50)
        assert {r.id: (r.shard, r._rn) for r in again.collect()} == want
        nulls = df.select(F.when(F.pmod("id", F.lit(3)) > 0, F.pmod("id", F.lit(3))).alias("g"), F.when(F.col("id") != 4, F.col("id")).alias("id"))
        got = sorted((r.g or 0, r._rn, -1 if r.id is None else r.id) for r in B.rank_in_group(nulls, "g", "id", 10).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    at = {g: sorted((float("-inf") if i == 4 else i) for i in crowded if i % 3 == g) for g in (0, 1, 2)}
    assert got == [(g, k, -1 if i == float("-inf") else i) for g in at for k, i in enumerate(at[g])]


def test_texts_are_moved_twice_for_prompts(spark):
    """Once to be numbered, once to be grouped; the offsets come to the tasks that number."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = spark.range(100).select("id", F.col("id").cast("string").alias("text"))
        plan = B.batch_prompts(B.chunk(df, "id", shards=4), "id", "text", "score:\n")._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert (sum("text#" in x for x in moved), sum("buf#" in x for x in moved)) == (1, 1)


def test_string_and_null_ids(spark):
    rows = [(f"r{i}", f"t{i}") for i in range(57)] + [(None, "n"), ("r3", "again")]
    df = spark.createDataFrame(rows, "id string, text string")
    p = B.batch_prompts(B.chunk(df, "id", 20, shards=2), "id", "text", "score:\n")
    assert sorted((i["id"] or "", i["text"]) for r in p.collect() for i in r["items"]) == sorted((a or "", b) for a, b in rows)
    assert max(r.n_items for r in p.collect()) == 20
    g = B.greedy_batches(df, "id", "text", max_items=10, shards=3).collect()
    assert len(g) == len(rows)
    sizes = {}
    for r in g:
        sizes[r.shard, r.batch] = sizes.get((r.shard, r.batch), 0) + 1
    assert max(sizes.values()) == 10


def test_failed_calls_are_rejected_with_their_error(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(40)], "id long, text string")

    def down(pdf):
        raise RuntimeError("service down")

    res, rejects = B.defect_scores(df, "id", "text", down, shards=1)
    assert res.count() == 0
    assert [(r.reason, r.error) for r in rejects.collect()] == [("failed", "RuntimeError: service down")] * 2


def test_translate_job(spark):
    from tessera.operators.translate import translate_job
    df = spark.createDataFrame([("a", "x", None), ("b", None, "y"), ("c", "fail", "z")], "id string, t string, u string")

    def call(pdf):
        out = []
        for items in pdf["items"]:
            if any(i["text"] == "fail" for i in items):
                raise RuntimeError("")
            out.append(json.dumps([{"translations": [{"text": "en " + i["text"], "to": "en"}]} for i in items]))
        return pd.Series(out)

    got = {r.id: r for r in translate_job(df, "id", ["t", "u"], call, shards=1, max_items=1, retries=2).collect()}
    assert (got["a"].t_en, got["a"].u_en, got["b"].t_en, got["b"].u_en) == ("en x", None, None, "en y")
    assert (got["c"].t_en, got["c"].t_error, got["c"].u_en) == (None, "RuntimeError: ", "en z")


def test_export_goes_on_after_an_error_without_text(spark, tmp_path):
    from tessera.sources.sinks import export_tables

    def broken():
        raise ValueError()

    got = {r.table: r for r in export_tables(spark, {"a": lambda: spark.range(3), "b": broken, "c": lambda: spark.range(0)},
                                             f"file://{tmp_path}").collect()}
    assert (got["a"].rows, got["b"].ok, got["b"].error, got["c"].rows) == (3, False, "ValueError: ", 0)


def test_merge_left_matches_null_keys_on_request(spark):
    from tessera.operators.joins import merge_left
    a = spark.createDataFrame([("x",), (None,)], "k string")
    b = spark.createDataFrame([("x", 1), (None, 2)], "j string, v int")
    assert sorted((r.k or "", r.v) for r in merge_left(a, b, "k", "j", ["v"], null_safe=True).collect()) == [("", 2), ("x", 1)]
    assert sorted((r.k or "", r.v) for r in merge_left(a, b, "k", "j", ["v"]).collect()) == [("", None), ("x", 1)]


def test_scratch_folders_can_be_dropped(spark):
    from tessera.session import drop_scratch, materialize
    df = materialize(spark.range(5))
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    assert df.count() == 5 and drop_scratch(spark) >= 1
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    assert not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    from tessera.plans.sales import refresh_dates
    refresh_dates()  # the Date tables were among them


def test_member_arrays(spark, monkeypatch):
    """Ragged groups, hot groups over several parts and buckets, null groups and members, repeated rows."""
    rows = [("hot", i) for i in range(500)] * 2 + [("one", 7), (None, 3), (None, 1), ("none", None), ("one", None)]
    monkeypatch.setattr(B, "rank_in_group", partial(B.rank_in_group, rows_a_bucket=16))
    for kind, text in (("long", lambda x: x), ("string", lambda x: None if x is None else f"m{x}")):
        df = spark.createDataFrame([(k, text(m), "x") for k, m in rows], f"k string, m {kind}, _rows string").repartition(5)
        out = B.member_arrays(df, "k", "m", 64).collect()
        parts = {(r["k"], r["part"]): r for r in out}
        assert len(parts) == len(out) == 8 + 1 + 1
        got = {k: [m for p in range(8) if (k, p) in parts for m in parts[k, p]["members"]] for k in ("hot", "one", None)}
        assert sorted(got["hot"]) == sorted(text(i) for i in range(500)) and got["one"] == [text(7)]
        assert sorted(got[None]) == [text(1), text(3)]
        assert [parts["hot", p]["n_members"] for p in range(8)] == [64] * 7 + [52]
        assert sum(parts["hot", p]["n_rows"] for p in range(8)) == 1000
        if kind == "long":
            assert got["hot"] == list(range(500)) and got[None] == [1, 3]
        again = B.member_arrays(df.repartition(2), "k", "m", 64).collect()
        assert sorted(map(str, again)) == sorted(map(str, out))
    assert B.member_arrays(df.limit(0), "k", "m").count() == 0
