"""Row-wise operators: token counts, quality rules, licence scan, against brute force and on odd rows."""
import collections
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import licenses, measures, quality_rules, tokens

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (None, "no id here"), (5, "a b c " * 7000), (5, "a b c " * 7000),
       (6, "x" * 30000), (7, "  word\x1cglued\x85"), (None, None)]


# --- token counts ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def counter():
    spec = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    return tokens.TokenCounter(spec, tokens.prove_whole_tokens(spec)), Tokenizer.from_str(spec)


TRICKY = ["", " ", "  \n\n x", "a<|endoftext|>b <|endoftext|>", "<|endoftext|><|endoftext|>", "don't we'll I'VE",
          "é日本語🙂 ́x", "\x85 a\xa0b \x1c", "\x00\x01", "12345 ½ ²x", "a" * 5000, "🙂" * 300, "tab\tnew\r\nline   end   "]


def test_tokens_equal_the_library(counter):
    mine, lib = counter
    for t in TRICKY:
        assert mine.count(t) == len(lib.encode(t, add_special_tokens=False).ids), repr(t)


def test_proven_strings_are_single_tokens(counter):
    spec = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    whole = tokens.prove_whole_tokens(spec)
    assert len(whole) > 45000
    assert all(len(counter[1].encode(w, add_special_tokens=False).ids) == 1 for w in whole[::97])


def test_long_text_and_forgetting(counter, monkeypatch):
    monkeypatch.setattr(tokens, "LONG_TEXT", 10)
    monkeypatch.setattr(tokens, "MEMO", 2)
    text = "some unusualish wordlets herein, thndly ereaing oneses " * 3
    assert counter[0].count(text) == len(counter[1].encode(text, add_special_tokens=False).ids)


def test_count_tokens_odd_rows(spark, frame):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    out = tokens.count_tokens(frame(ODD, extra=True), path).collect()
    assert len(out) == len(ODD)
    for r in out:
        text = r["text"] or ""
        assert r["n_bytes"] == len(text.encode())
        assert r["n_tokens"] == len(lib.encode(text, add_special_tokens=False).ids)
        assert r["over_limit"] == (r["n_tokens"] > 512)
    assert tokens.count_tokens(frame([]), path).count() == 0


# --- quality rules ----------------------------------------------------------------------------------

def brute(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = collections.Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    hit = {i + k for i in range(len(ws) - 2) if grams[tuple(ws[i:i + 3])] > 1 for k in range(3)}
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


@pytest.mark.parametrize("text", [t for _, t in ODD] + ["a b c d a b c", "l1\nl1\n\n l1\nl1 ", "x\x0by z\x0cx", "# $5 *|* <b>",
                                                       "a a a a a", "é è é è é è", "a b a b a"])
def test_measures_equal_brute_force(text):
    assert measures.measure((text or "").encode())[:5] == brute(text)


def test_ledger_odd_rows_and_policies(spark, frame):
    led = quality_rules.quality_ledger(frame(ODD, extra=True))
    rows = led.collect()
    assert len(rows) == len(ODD) and "score" in led.columns and "text" not in led.columns
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        full = quality_rules.mask(quality_rules.POLICIES[quality_rules.CURRENT])
        assert r["kept"] == (not r["base_failed"] and r["fail_bits"] & full == 0)
    assert quality_rules.quality_ledger(frame([])).count() == 0


def test_ablation_equals_reapplying_the_policy(spark, frame):
    clean = " ".join(f"word{i}" for i in range(80))
    docs = [(i, t) for i, t in enumerate([clean, clean.upper(), "### " * 100, "short", clean + " !!!" * 40, None])]
    led = quality_rules.quality_ledger(frame(docs))
    got = {r["rule"]: r for r in quality_rules.ablation(led).collect()}
    rows, full = led.collect(), quality_rules.mask(quality_rules.POLICIES[quality_rules.CURRENT])
    for rule in quality_rules.RULES:
        bit = 1 << rule.bit
        assert got[rule.name]["failing"] == sum(r["fail_bits"] & bit != 0 for r in rows)
        assert got[rule.name]["failing_alone"] == sum(r["fail_bits"] & full == bit for r in rows)
        assert got[rule.name]["kept_without"] == sum(r["fail_bits"] & full & ~bit == 0 for r in rows)


def test_bits_are_unique():
    assert len({r.bit for r in quality_rules.RULES}) == len(quality_rules.RULES)


# --- licence scan -----------------------------------------------------------------------------------

MIT = """Some words first
// Copyright (c) 2019 Somebody
//
// Permission is hereby granted, free of charge, to any person obtaining a copy of this
// software and associated documentation files, to deal in the Software.
//
// The above copyright notice and this permission notice shall be included in all copies.
//
// THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.
// IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY.
See the GNU General Public License for more details. You should have received a copy of the GNU General Public
License along with this program."""


@pytest.mark.parametrize("text, found, verdict", [
    ("No such thing here.", [], "none"), (None, [], "none"), ("", [], "none"),
    ("Released under the MIT License.", ["MIT"], "one"),
    ("Licensed under the Apache Licence,\n Version 2.0.", ["Apache-2.0"], "one"),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"], "one"),
    ("Licensed under CC BY-NC 4.0. All rights reserved.", ["CC-BY-NC", "All-Rights-Reserved"], "several"),
    ("Licensed under our own licence, ask us.", [], "unknown"),
    ("SPDX-License-Identifier: MIT", ["MIT"], "one"), (MIT, ["MIT"], "one"), (GPL, ["GPL-3.0-or-later"], "one")])
def test_licences(spark, frame, text, found, verdict):
    r = licenses.scan(frame([(1, text)], extra=True)).first()
    assert (r["licenses"], r["verdict"]) == (found, verdict), r["sentence_ids"]


def test_licence_scan_odd_rows(spark, frame):
    long = "word " * 40000 + ". Released under the MIT License. " + "word " * 1000
    rows = licenses.scan(frame(ODD + [(9, long)] * 2)).collect()
    assert len(rows) == len(ODD) + 2
    assert [r["licenses"] for r in rows if r["doc_id"] == 9] == [["MIT"]] * 2
    assert licenses.scan(frame([])).count() == 0


def test_every_sentence_has_a_stem_and_every_rule_known_sentences():
    names = {n for n, _ in licenses.SENTENCES}
    assert all({n.rstrip("?") for n in needs} <= names | {"SpdxOther"} for _, needs in licenses.RULES)
    for _, pattern in licenses.SENTENCES:  # each alternative of a pattern must hold a stem or follow one
        assert any(s in pattern.replace("\\", "") for s in licenses.STEMS), pattern


def test_plan_is_native(spark, frame):
    plan = licenses.scan(frame([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
