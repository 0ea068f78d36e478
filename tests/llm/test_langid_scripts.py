"""Languages whose letters are not among the most frequent ones of Latin-script tables."""
import random

import numpy as np

from tessera.llm import langid

WORDS = {
    "zh": "我们 今天 学习 中文 天气 非常 朋友 他们 图书馆 喜欢 电影 音乐 老师 学生 问题 时间".split(),
    "ja": "わたし たち きょう 日本語 天気 とても 友達 かれら 図書館 すき 映画 おんがく 先生 学生 もんだい 時間".split(),
    "ko": "우리 오늘 한국어 날씨 매우 친구 그들 도서관 좋아 영화 음악 선생님 학생 문제 시간 사람".split(),
    "ru": "мы сегодня учим русский погода очень друзья они библиотека любит фильм музыка учитель вопрос время".split(),
    "uk": "ми сьогодні вчимо українську погода дуже друзі вони бібліотека любить фільм музика вчитель питання".split(),
    "el": "εμείς σήμερα μαθαίνουμε ελληνικά καιρός πολύ φίλοι αυτοί βιβλιοθήκη ταινία μουσική δάσκαλος χρόνος".split(),
    "en": "we today learn english weather very friends they library likes movie music teacher student question".split(),
    "de": "wir heute lernen deutsch wetter sehr freunde sie bibliothek mag film musik lehrer schüler frage zeit".split()}


def test_scripts_are_told_apart(spark, frame):
    rng, rows = random.Random(5), []
    for lang, words in WORDS.items():
        for _ in range(40):
            rows.append((len(rows), " ".join(rng.choice(words) for _ in range(12)), lang))
    out = {r["doc_id"]: r for r in langid.identify_languages(frame(rows)).collect()}
    held = [(lang, out[i]["lang_pred"]) for i, _, lang in rows if out[i]["held_out"]]
    assert {lang for lang, _ in held} == set(WORDS)
    assert all(a == b for a, b in held), [x for x in held if x[0] != x[1]]


def test_ngrams_are_those_of_the_letters():
    for a, b in [("日", "本"), ("한", "국"), ("ж", "щ"), ("あ", "ア"), ("𠀀", "𠀁")]:
        assert not np.array_equal(langid.ngrams(a, langid.every_letter()), langid.ngrams(b, langid.every_letter()))
    every = langid.every_letter()
    assert len(langid.ngrams("日本、日本🙂", every)) == len({"_", "日", "本", "_日", "日本", "本_", "_日本", "日本_", "本_日"})


def test_repeated_id_is_one_of_the_sample(spark):
    """An id that is repeated a thousand times takes one place of its language's sample."""
    from tessera.llm import langid
    from pyspark.sql import functions as F
    rows = [(i, f"the word {'abcdefgh'[i % 8]}{i} of it", "en") for i in range(400)] + [(1000 + i, f"das wort {i} für es", "de") for i in range(400)]
    docs = spark.createDataFrame(rows + [rows[0]] * 1000 + [rows[3]] * 1000, "doc_id long, text string, lang string")
    once, often = langid.learn(spark.createDataFrame(rows, docs.schema), 50), langid.learn(docs, 50)
    assert (once.vocabulary == often.vocabulary).all() and (abs(once.weights - often.weights) < 1e-12).all()
    got = langid.identify(docs.select("doc_id", "text"), often).join(docs.select("doc_id", "lang").distinct(), "doc_id")
    assert got.filter(F.col("lang") != F.col("lang_pred")).count() == 0
