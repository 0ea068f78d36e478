"""Chat formatting, source mixing and sharding against plain Python versions and on odd rows."""
import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import chat, mixing, sharding

# --- templates -----------------------------------------------------------------------------------


def render(template, messages):
    return list(chat.compile_template(template)(messages))


def text_of(template, messages=()):
    return "".join(t for t, _ in render(template, messages))


@pytest.mark.parametrize("template, wanted", [
    ("a{{ 'b' ~ 1 }}c{# no #}", "ab1c"), ("{% if true and not false %}x{% else %}y{% endif %}", "x"),
    ("{% if 1 > 2 %}x{% elif 'a' == 'a' %}y{% endif %}", "y"), ("{{ ' q ' | trim | upper }}", "Q"),
    ("{% set n = 'v' %}{{ n ~ n }}", "vv"), ("{{ missing.field }}|", "|"), ("{{ ('a' ~ 'b') | length }}", "2"),
    (r"{{ 'it\'s\n' }}", "it's\n")])
def test_language(template, wanted):
    assert text_of(template) == wanted


def test_loop_and_generation():
    t = "{% for m in messages %}{{ loop.index }}{% if loop.first %}F{% endif %}{% if loop.last %}L{% endif %}" \
        "{% generation %}{{ m.text }}{% endgeneration %};{% endfor %}"
    got = render(t, [{"role": "r", "text": "x"}, {"role": "r", "text": "y"}])
    assert "".join(a for a, _ in got) == "1Fx;2Ly;"
    assert [a for a, inside in got if inside] == ["x", "y"]


def test_constants_are_folded():
    tree = chat.fold(chat.parse("a{{ 'b' ~ 'c' }}{% if 1 == 2 %}{{ m }}{% else %}d{% endif %}"))
    assert tree == ("block", [("text", "abcd")])


@pytest.mark.parametrize("bad", ["{% for x in other %}{% endfor %}", "{{ m.__class__ }}", "{{ f(1) }}", "{{ x | open }}",
                                 "{% if true %}", "{% endif %}", "{{ }}", "{% import os %}", "{{ 'a' 'b' }}",
                                 "{% for a in messages %}{% for b in messages %}{% endfor %}{% endfor %}"])
def test_sandbox(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)


HARD = ["", "\\", "####", "##", "</turn>", "\\</turn>", "<</turn>></role>", "### Assistant: </turn>\n", "a\n### User: b", "🙂é"]


@pytest.mark.parametrize("text", HARD)
def test_escape_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text
    for role in ("user", "assistant", "system", "tool", "User", "", text):
        out = text_of(chat.TEMPLATE, [{"role": role, "text": text}, {"role": "user", "text": text}])
        assert list(chat.read_back(out)) == [(role, text), ("user", text)]


def wanted(turns):
    order = lambda x: (x is not None, x)
    turns = sorted(turns, key=lambda t: tuple(map(order, t)))
    pairs = [(r or "", t or "") for _, r, t in turns]
    all_text = "".join(f"{r}\n{t}\n" for r, t in pairs)
    loss = "".join(t for r, t in pairs if r == "assistant")
    return len(pairs), hashlib.sha256(all_text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("part", [1 << 20, 50])
def test_conversations(spark, part):
    rows = [(c, i, ["user", "assistant", None, "tool"][i % 4], t) for c in (1, 2, None) for i, t in enumerate(HARD)]
    rows += [(3, 0, "assistant", None), (4, None, "user", "x"), (4, 1, "user", "b"), (4, 1, "user", "a"), (4, 1, "user", "a"),
             (5, 0, "assistant", "long " * 50000)]
    df = spark.createDataFrame([r + ("extra",) for r in rows], "conv_id long, turn long, role string, text string, part string")
    out = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(df, part_chars=part)).collect()}
    by = collections.defaultdict(list)
    for c, i, r, t in rows:
        by[c].append((i, r, t))
    assert set(out) == set(by)
    for c, turns in by.items():
        r = out[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == wanted(turns), c
    parts = chat.format_conversations(df, part_chars=part).filter("conv_id = 1").count()
    assert parts == 1 if part > 50 else parts > 1
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0
    straight = chat.digests(chat.format_conversations(df, part_chars=part), in_order=True)
    assert {r["conv_id"]: r for r in straight.collect()} == out


def test_parts_in_any_order(spark, tmp_path):
    """Formatted rows that were dealt anew, written and read again give the same digests."""
    rows = [(c, i, "assistant" if i % 2 else "user", f"{t} {c}") for c in (1, 2, None) for i, t in enumerate(HARD)]
    parts = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), part_chars=50)
    assert parts.filter("part > 0").count() > 0
    path = f"file://{tmp_path}/parts"
    parts.repartition(7, F.col("part")).orderBy(F.desc("part")).write.parquet(path)
    same = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert same(chat.digests(spark.read.parquet(path))) == same(chat.digests(parts, in_order=True))


# --- sharding --------------------------------------------------------------------------------------

def test_table_is_full_and_even():
    for n in (1, 3, 32):
        counts = collections.Counter(sharding.fill_table(sharding.names(n), 257))
        assert len(counts) == n and max(counts.values()) - min(counts.values()) <= 1


def test_turns_as_written_down():
    """Shard after shard claims its most preferred free slot."""
    names, m = sharding.names(5), 53
    prefs = [[(a + j * d) % m for j in range(m)] for a, d in (sharding.preference(n, m) for n in names)]
    table, i = {}, 0
    while len(table) < m:
        slot = next(s for s in prefs[i % 5] if s not in table)
        table[slot] = i % 5
        i += 1
    assert sharding.fill_table(names, m) == [table[s] for s in range(m)]


def test_losing_a_shard_moves_little_else():
    before, after = sharding.fill_table(sharding.names(16), 4099), sharding.fill_table(sharding.names(15), 4099)
    moved = sum(a != b for a, b in zip(before, after) if a != 15)
    assert moved < 0.25 * 4099


def test_weights_and_errors():
    counts = collections.Counter(sharding.fill_table(["a", "b"], 997, [3, 1]))
    assert abs(counts[0] / counts[1] - 3) < 0.05
    for bad in (([], 7, None), (["a"], 8, None), (["a", "b"], 7, [0, 0])):
        with pytest.raises(ValueError):
            sharding.fill_table(*bad)


def test_placing_odd_rows(spark, frame):
    docs = frame([(i, "x", "en", f"s{i % 3}") for i in range(3000)] + [(5, "x", "en", "s2"), (None, None, None, None), (None, "y")],
                 extra=True)
    out = sharding.place(docs)
    rows = out.collect()
    assert len(rows) == 3003 and set(out.columns) == set(docs.columns)
    assert len({r["shard"] for r in rows if r["doc_id"] == 5}) == 1
    counts = collections.Counter(r["shard"] for r in rows)
    assert len(counts) == sharding.SHARDS and max(counts.values()) < 2 * 3003 / sharding.SHARDS
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "SortMergeJoin" not in plan
    assert sharding.place(frame([])).count() == 0


def test_written_shards(spark, frame, tmp_path):
    out = sharding.place(frame([(i, "x") for i in range(500)]))
    sharding.write_shards(out, f"file://{tmp_path}/a", files=2)
    assert spark.read.parquet(f"file://{tmp_path}/a").count() == 500


def test_written_shards_by_rows(spark, frame, tmp_path, monkeypatch):
    """By default a shard has as many files as its rows need, and a rerun deals the rows alike."""
    monkeypatch.setattr(sharding, "ROWS_A_FILE", 5)
    out = sharding.place(frame([(i, "x") for i in range(500)] + [(None, None), (7, "x")]))
    dealt = []
    for name in ("a", "b"):
        path = f"file://{tmp_path}/{name}"
        sharding.write_shards(out.repartition(3 if name == "a" else 5), path)
        back = spark.read.parquet(path)
        assert back.count() == 502 and sorted(back.columns) == sorted(out.columns)
        files = back.groupBy("shard", F.input_file_name().alias("f")).agg(F.sort_array(F.collect_list("doc_id")).alias("ids"))
        dealt.append(sorted((r["shard"], r["ids"]) for r in files.collect()))
    assert len(dealt[0]) > sharding.SHARDS and dealt[0] == dealt[1]
    sharding.write_shards(out.limit(0), f"file://{tmp_path}/none")


# --- mixing ----------------------------------------------------------------------------------------

def brute_targets(sizes):
    """Targets by resharing the excess again and again; sizes: {source: words}."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / w for s in order}
        over = {s for s in order if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def sainte_lague(votes, seats, most):
    got = dict.fromkeys(votes, 0)
    for _ in range(seats):
        s = max((s for s in votes if got[s] < most[s]), key=lambda s: (votes[s] / (got[s] + 0.5), -s))
        got[s] += 1
    return got


def corpus(frame, extra=False):
    words = lambda n, k: " ".join(f"w{k}_{i}" for i in range(n))
    rows = [(i, words(5 + 7 * (i % 40), i), "en", ["a", "b", "c", "é", "Z", None][(i * i) % 6 if i % 3 else 0]) for i in range(600)]
    rows += [(9000, None, "en", "a"), (9001, "", "en", "empty"), (9002, words(3, 1), "en", "tiny"), (9002, words(3, 1), "en", "tiny"),
             (None, words(30, 2), "en", "b"), (None, words(30, 2), "en", "b"), (9003, words(20000, 3), "en", "c")]
    return frame(rows, extra)


def test_mix_plan(spark, frame):
    docs = corpus(frame, extra=True)
    rows = mixing.mix_plan(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    target = brute_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(2, 0.01 * target[s]), s
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
    again = mixing.mix_plan(docs.repartition(7)).collect()
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert mixing.mix_plan(frame([])).count() == 0


def test_quotas_are_sainte_lague(spark, frame):
    src = mixing.quotas(mixing.targets(mixing.sized(corpus(frame)))).collect()
    votes = {r["rank"]: r["target"] / r["block"] for r in src}
    seats = round(sum(votes.values()))
    assert {r["rank"]: r["quota"] for r in src} == sainte_lague(votes, seats, {r["rank"]: 3 * r["blocks"] for r in src})


def test_buckets_do_not_change_the_plan(spark, frame, monkeypatch):
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
    one = sorted(map(key, mixing.mix_plan(corpus(frame)).collect()))
    monkeypatch.setattr(mixing, "ROWS_A_BUCKET", 20)
    assert sorted(map(key, mixing.mix_plan(corpus(frame)).collect())) == one


def test_mixture_holds_the_words_taken(spark, frame):
    docs = corpus(frame, extra=True)
    plan = collections.Counter()
    for r in mixing.mix_plan(docs).collect():
        plan[r["doc_id"]] += r["taken"]
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    got, text = collections.Counter(), {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in out.collect():
        got[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"]) and set(r["text"].split()) <= set(text[r["doc_id"]].split())
    assert got == +plan


def test_mixture_of_rows_with_one_id_is_the_same_on_reruns(spark, frame):
    """Rows of one id and size with different texts have an order: however the rows lie, the same texts are cut."""
    rows = [(5, " ".join(f"w{k}x{i}" for i in range(90))) for k in range(40)] + [(i, "a b c") for i in range(30)]
    one, two = (sorted(r["text"] for r in mixing.mixed(frame(part).repartition(3)).collect())
                for part in (rows, rows[::-1]))
    assert one == two and mixing.mixed(frame([])).count() == 0


def test_cut_words():
    assert mixing.cut_words("a  b\tc d", [0, 1, 3], [1, 2, 4]) == "a  b\nd"
