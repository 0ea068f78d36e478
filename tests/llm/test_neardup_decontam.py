"""Near-duplicates and decontamination against brute force, planted cases and odd rows."""
import collections
import random
import re

import numpy as np
import pytest

from tessera.llm import decontam, neardup, shingles

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def shingle_tuples(text):
    ws = word_list(text)
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())


def brute_groups(docs, percent=85):
    """[(doc_id, n_shingles, component_id)] from all pairs, linked from `percent` on."""
    sets = [shingle_tuples(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least.setdefault(find(i), []).append(d)
    ids = lambda g: min((d for d in g if d is not None), default=None)
    return [(d, len(sets[i]), ids(least[find(i)])) for i, (d, _) in enumerate(docs)]


def near_copies(rng, base, n, most):
    out = []
    for _ in range(n):
        ws = list(base)
        for _ in range(rng.randrange(most + 1)):
            ws[rng.randrange(len(ws))] = f"e{rng.randrange(10 ** 6)}"
        out.append(" ".join(ws))
    return out


def corpus():
    rng = random.Random(8)
    docs = [" ".join(f"v{rng.randrange(3000)}" for _ in range(rng.randrange(5, 200))) for _ in range(60)]
    base = [f"b{rng.randrange(3000)}" for _ in range(150)]
    docs += near_copies(rng, base, 150, 6)             # a group whose members are linked to some of it only
    chain = [f"c{i}" for i in range(200)]
    for k in range(20):                                # linked in a row, ends far apart
        docs.append(" ".join(chain[2 * k:2 * k + 120]))
    docs += [docs[0]] * 40 + [docs[1].upper()] + ["few words", "few  words", "few words here", "", None, " \t\n", "one"]
    rng.shuffle(docs)
    return [(1000 + 3 * i, t) for i, t in enumerate(docs)]


def rows_of(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def test_groups_equal_all_pairs(spark, frame):
    docs = corpus()
    out = neardup.groups(frame(docs, extra=True))
    assert rows_of(out) == sorted(brute_groups(docs), key=str)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out.collect())


def test_small_blocks_lose_no_link(spark, frame, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_SETS", 16)
    docs = corpus()
    assert rows_of(neardup.groups(frame(docs))) == sorted(brute_groups(docs), key=str)


def test_null_ids_repeated_rows_and_empty_table(spark, frame):
    text = " ".join(f"w{i}" for i in range(50))
    docs = [(None, text), (7, text + " x"), (7, text), (7, text), (5, "other words entirely in this one"), (None, "alone here"),
            (None, ""), (9, "long " * 30000), (8, "long " * 29999)]
    assert rows_of(neardup.groups(frame(docs))) == sorted(brute_groups(docs), key=str)
    kept = neardup.deduplicate(frame(docs, extra=True))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["5", "7", "8", "None", "None"] and "digest" in kept.columns
    assert neardup.groups(frame([])).count() == 0 and neardup.deduplicate(frame([])).count() == 0


def test_word_hashes_and_shingles():
    for t in ["a b c d e f", "A b\x0bc\x0cd\re", "é É x\x1cy z ü", "x " * 300, ""]:
        h = shingles.word_hashes(t.encode())
        ws = word_list(t)
        assert len(h) == len(ws)
        assert all((h[i] == h[j]) == (ws[i] == ws[j]) for i in range(0, len(ws), 7) for j in range(len(ws)))
        assert len(shingles.shingle_set(t.encode())) == len(shingle_tuples(t))


def test_odd_sketch_estimates():
    rng = np.random.default_rng(2)
    for j in (0.5, 0.7, 0.85, 0.95):
        got = []
        for _ in range(40):
            pool = rng.integers(0, 2 ** 63, 2000, np.uint64)
            common = int(1000 * 2 * j / (1 + j))
            a, b = pool[:1000], np.concatenate([pool[:common], pool[1000:2000 - common]])
            x, y = (neardup.odd_sketch(neardup._HASHES.samples(s)) for s in (a, b))
            got.append(float(neardup.estimate(np.bitwise_count(x ^ y).sum())))
        assert abs(np.mean(got) - j) < 0.03
        if j >= 0.85:
            assert min(got) > j - neardup.SLACK


def test_matrix_and_pairwise_intersections_agree():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 400, 300).astype(np.uint64)) for _ in range(30)]
    every = np.array([(i, j) for i in range(30) for j in range(30)])
    many = neardup.linked_pairs(sets, sets, every)
    few = np.concatenate([neardup.linked_pairs(sets, sets, every[k:k + 9]) for k in range(0, 900, 9)])
    assert (many == few).all() and many.any()


def test_a_row_repeated_many_times_and_keys_of_128_bits(spark, frame):
    """Copies of one row meet their class once, and ids do not run into texts in the row key."""
    base = [f"b{i}" for i in range(60)]
    near = base[:30] + ["z"] + base[31:]
    docs = [(5, " ".join(base))] * 300 + [(6, " ".join(base[:58] + ["y", "x"])), (7, " ".join(near)), (1, "1 a"), (11, " a")]
    got = sorted({tuple(r) for r in rows_of(neardup.groups(frame(docs), percent=80))}, key=str)
    assert got == sorted({tuple(r) for r in brute_groups(docs, 80)}, key=str)
    keys = frame(docs).select(neardup.row_key().alias("k")).distinct().collect()
    assert len(keys) == 5 and all(len(r["k"]) == 16 for r in keys)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 300)] + [(5000 + i, 5000 + rng.randrange(400)) for i in range(400)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in neardup.components(df, "t").collect()}
    assert got == {n: find(n) for n in root if any(n in e and e[0] != e[1] for e in edges)}
    assert neardup.components(df.limit(0), "t").count() == 0


# --- decontamination ---------------------------------------------------------------------------------

def brute_hits(docs, items):
    """{(doc_id, item_id): best similarity} over all windows of the item's length."""
    counts = lambda ws: collections.Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    known = {i: counts(word_list(t)) for i, t in items if len(word_list(t)) >= 5}
    short = {i: word_list(t) for i, t in items if 0 < len(word_list(t)) < 5}  # one shingle, the whole sequence
    out = {}
    for d, t in docs:
        ws = word_list(t)
        out |= {(d, i): 1.0 for i, s in short.items() if any(ws[at:at + len(s)] == s for at in range(len(ws)))}
        for i, c in known.items():
            n = min(sum(c.values()) + 4, len(ws))
            for at in range(len(ws) - n + 1):
                w = counts(ws[at:at + n])
                common = sum((w & c).values())
                x = common / max(1, sum(w.values()) + sum(c.values()) - common)
                if x >= 0.8:
                    out[d, i] = max(out.get((d, i), 0), x)
    return out


def leak_case():
    rng = random.Random(6)
    text = lambda n: [f"t{rng.randrange(500)}" for _ in range(n)]
    items = [text(n) for n in (5, 6, 15, 20, 31, 45, 59, 60, 80)] + [["z"] * 20, ["a", "b"] * 12, text(4)]
    docs = [" ".join(text(rng.randrange(0, 120))) for _ in range(20)]
    for it in items:
        docs.append(" ".join(text(30) + it + text(25)))                            # exact
        docs.append("\n".join(text(10)) + "\t" + "  ".join(it).upper())            # other spacing and case, at the end
        changed = list(it)
        changed[len(it) // 2] = "changed"
        docs.append(" ".join(text(12) + changed + text(9)))                        # a word replaced
        docs.append(" ".join(text(12) + it[:len(it) // 2] + ["more"] + it[len(it) // 2:] + text(9)))
        docs.append(" ".join(text(12) + it[: -max(1, len(it) // 10)] + text(9)))   # cut off
        docs.append(" ".join(it[: len(it) // 2]))                                  # half of it: no copy
        docs.append(" ".join((it + text(3)) * 3))                                  # three times
    return list(enumerate(docs)), [(100 + i, " ".join(it)) for i, it in enumerate(items)]


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_contaminated_equals_all_windows(spark, frame):
    docs, items = leak_case()
    odd = [(900, None), (901, ""), (902, "a b c"), (None, items[5][1]), (903, "w " * 30000 + items[6][1])]
    out = decontam.contaminated(frame(docs + odd, extra=True), items_frame(spark, items + items[:3] + [(1, None), (2, ""), (None, None)]))
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in out.collect()}
    want = brute_hits(docs + odd[:4], items)
    want[903, 106] = 1.0
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_short_items_are_whole_sequences(spark, frame):
    items = [(1, "one two"), (2, "Single"), (3, "a b c d"), (4, "two one"), (5, " "), (6, "one two")]
    docs = [(1, "x one two y one two"), (2, "one  two"), (3, "one"), (4, "a b c e a b c d"), (5, "single."), (6, "A B\nC D"), (7, None)]
    out = decontam.contaminated(frame(docs), items_frame(spark, items)).collect()
    assert sorted((r["doc_id"], r["item_id"], r["start_word"], r["n_words"]) for r in out) == [
        (1, 1, 1, 2), (1, 6, 1, 2), (2, 1, 0, 2), (2, 6, 0, 2), (4, 3, 4, 4), (6, 3, 0, 4)]
    assert {(r["doc_id"], r["item_id"]) for r in out} == set(brute_hits(docs, items))


@pytest.mark.parametrize("words, replaced, found", [(48, 1, False), (49, 1, True), (93, 2, False), (94, 2, True)])
def test_replaced_words(spark, frame, words, replaced, found):
    """From which length on a copy with one or two words replaced in the middle is found."""
    item = [f"w{i}" for i in range(words)]
    copy = list(item)
    for k in range(replaced):
        copy[(k + 1) * words // (replaced + 1)] = "other"
    out = decontam.contaminated(frame([(1, " ".join(["x"] * 9 + copy + ["y"] * 9))]), items_frame(spark, [(1, " ".join(item))]))
    assert out.count() == int(found)


def test_more_than_one_pass_and_table(spark, frame, monkeypatch):
    monkeypatch.setattr(decontam, "TABLE_ITEMS", 3)
    docs, items = leak_case()
    once = decontam.contaminated(frame(docs), items_frame(spark, items)).collect()
    blocks = decontam.blocks_of
    monkeypatch.setattr(decontam, "blocks_of", lambda b: blocks(b, 4))
    assert len(list(blocks(items_frame(spark, items), 4))) == 3
    assert sorted(decontam.contaminated(frame(docs), items_frame(spark, items)).collect()) == sorted(once)


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 2 ** 64, 300, np.uint64)
    index = decontam.MultiIndex(prints)
    probes = prints[:60].copy()
    for k in range(60):
        for bit in rng.permutation(64)[:k % 24]:
            probes[k] ^= np.uint64(1) << np.uint64(bit)
    apart = np.bitwise_count(probes[:, None] ^ prints[None, :])
    want = [(k, i, int(apart[k, i])) for k in range(60) for i in range(300) if apart[k, i] <= decontam.RADIUS]
    assert list(zip(*(x.tolist() for x in index.within(probes)))) == want
    assert all(len(x) == 0 for x in index.within(probes[:0]))


def test_fingerprints_alone_make_the_candidates(monkeypatch):
    """Without the multi-index nothing is found, whatever shingles a text shares with an item."""
    docs, items = leak_case()
    items = items[:-1]  # without the one of four words
    ready = decontam.Benchmark(items)
    texts = [t.encode() for _, t in docs]
    assert sum(len(ready._long(shingles.word_hashes(t))) for t in texts) == len(brute_hits(docs, items))
    monkeypatch.setattr(decontam.MultiIndex, "within", lambda self, prints: (np.zeros(0, np.int64),) * 3)
    assert not any(ready._long(shingles.word_hashes(t)) for t in texts)


def test_long_texts_and_small_runs_of_windows(monkeypatch):
    """The same hits however many windows are looked up at once."""
    docs, items = leak_case()
    text = (" gap " * 50).join(t for _, t in docs).encode()
    ready = decontam.Benchmark(items)
    once = ready.search(text)
    monkeypatch.setattr(decontam, "WINDOWS", 7)
    assert ready.search(text) == once and len(once) >= 11


def test_decontaminate_keeps_clean_documents(spark, frame):
    docs, items = leak_case()
    bad = {d for d, _ in brute_hits(docs, items)}
    kept = decontam.decontaminate(frame(docs, extra=True), items_frame(spark, items))
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - bad
    assert "__hits" in kept.columns
    assert decontam.decontaminate(frame(docs), items_frame(spark, [])).count() == len(docs)
    assert decontam.contaminated(frame([]), items_frame(spark, items)).count() == 0
