"""Nulls, empty and very long texts, repeated rows, clashing columns and empty tables through every operator."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from reelstat.llm import bag_minhash, decontaminate, html_extract, katz_lm, langid, license_scan, line_dedup, quality_zstd
from reelstat.llm import sentencepiece_codec, warc

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
PROSE = "The quick brown fox jumps over the lazy dog and then it rests for a while. " * 3
ROWS = [
    (1, None, None),
    (2, "", "en"),
    (3, " \n\t ", "en"),
    (4, LONG, "en"),
    (5, PROSE, "en"),
    (5, PROSE, "en"),
    (6, PROSE, None),
    (7, "licensed under CC BY-NC 4.0.\nAll rights reserved", "de"),
    (8, "ein kurzer Satz über Äpfel und Öl\n\nein kurzer Satz über Äpfel und Öl", "de"),
    (9, "12345 !!!", None),
]
CLASHING = ["id", "h", "k", "n", "size", "label", "node", "root", "line", "place", "words", "chunk", "code", "key", "owner", "digest", "ids", "rest"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    return df.withColumns({c: F.lit(f"other {c}") for c in CLASHING})


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, " ".join(LONG.split()[500:540])), (4, "Äpfel und")], "item_id long, text string")


def rows(df):
    return sorted(df.collect(), key=lambda r: tuple(str(x) for x in r))


def test_tokens(docs):
    out = rows(sentencepiece_codec.decode(sentencepiece_codec.encode(docs, MODEL), MODEL, text_col="back").select("doc_id", "text", "ids", "back"))
    assert len(out) == len(ROWS)
    assert all(r.back == (r.text or "") for r in out)
    assert [len(r.ids) for r in out if not r.text] == [0, 0]
    assert sentencepiece_codec.encode(docs.limit(0), MODEL).count() == 0


def test_line_dedup(docs):
    out = rows(line_dedup.dedup_lines(docs, others=("lang", "rest")))
    assert len(out) == len(ROWS) and {r.rest for r in out} == {"other rest"}
    texts = {r.doc_id: r.text for r in out}
    assert texts[1] == "" and texts[2] == "" and texts[3] == " \n\t "
    assert texts[4] == LONG and texts[5] == PROSE and texts[6] == ""
    assert texts[8] == "ein kurzer Satz über Äpfel und Öl\n"
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_katz(docs):
    out = rows(katz_lm.score(docs, F.col("doc_id") == 9))
    assert len(out) == len(ROWS)
    assert [r.n_tokens for r in out if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    assert all(r.score < 0 and r.base_score < 0 for r in out)
    assert katz_lm.score(docs.limit(0), F.col("doc_id") == 9).count() == 0
    assert [r.train_tokens for r in katz_lm.score(docs.where("doc_id = 2"), F.lit(True)).collect()] == [0]


def test_licenses(docs):
    out = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert len(out) == 9 and license_scan.scan(docs).count() == len(ROWS)
    assert out[7].base_labels == "cc-by,reserved" and "cc-by-nc" in out[7].labels and (out[7].first_word, out[7].last_word) == (2, 7)
    assert (out[1].n_words, out[1].labels, out[1].score, out[1].first_word) == (0, "", 0.0, None)
    assert license_scan.scan(docs.limit(0)).count() == 0


def test_quality(docs):
    out = rows(quality_zstd.score_quality(docs))
    assert len(out) == len(ROWS)
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in out if r.doc_id in (1, 2, 3))
    assert quality_zstd.score_quality(docs.limit(0)).count() == 0


def test_near_duplicates(docs):
    out = rows(bag_minhash.near_duplicates(docs))
    classes = {r.doc_id: r.class_id for r in out}
    assert len(out) == len(ROWS)
    assert classes == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8, 9: 9}
    kept = bag_minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 7, 8, 9]
    assert bag_minhash.near_duplicates(docs.limit(0)).count() == 0


def test_decontamination(docs, items):
    out = [(r.doc_id, r.item_id, r.first_word) for r in rows(decontaminate.contaminated(docs, items))]
    assert out == [(4, 3, 500), (8, 4, 4)]
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()) == [1, 2, 3, 5, 5, 6, 7, 9]
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0


@pytest.fixture(scope="module")
def pages(spark):
    body = "<html><body><nav>m</nav><article><p>text {}</p></article></body></html>"
    data = [(1, "http://a.b/1", body.format(1)), (2, None, None), (3, "http://a.b/1", ""), (4, "x y\n", body.format(1)), (4, "x y\n", body.format(1)),
            (5, "http://a.b/5", "<p>" + "long " * 40_000)]
    return spark.createDataFrame(data, "page_id long, url string, html string").withColumns({c: F.lit(c) for c in ("host", "token", "sha1", "value")})


def test_html(pages):
    out = rows(html_extract.extract(pages))
    texts = {r.page_id: r.text for r in out}
    assert len(out) == 6 and texts[1] == "text 1" and texts[2] == "" and texts[4] == "text 1"
    assert len(texts[5]) == 5 * 40_000 - 1 and all(r.n_chars == len(r.text) for r in out)
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_warc(pages):
    out = sorted(warc.capture_histories(pages).collect(), key=lambda r: (r.shard, r.position))
    assert len(out) == 6
    assert [(r.url_key, r.timestamp, r.page_id) for r in out] == sorted((r.url_key, r.timestamp, r.page_id) for r in out)
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in out}
    assert kinds == {1: ("response", None), 2: ("response", None), 3: ("revisit", 2), 4: ("revisit", 1), 5: ("response", None)}
    data = {r.page_id: r.html or "" for r in pages.collect()}
    assert all(r.payload_bytes == len(data[r.page_id].encode()) for r in out)
    assert warc.capture_histories(pages.limit(0)).count() == 0


def test_language(docs):
    models = langid.learn(docs)
    out = rows(langid.predict(docs, models))
    assert len(out) == len(ROWS)
    assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in out if r.doc_id in (1, 2, 3, 9))
    assert {r.lang_pred for r in out} <= {"en", "de", "und"}
    assert langid.drop_rejected(docs, models).columns == docs.columns
    assert langid.learn(docs.limit(0)) is None
    assert langid.predict(docs, None).where("lang_pred <> 'und'").count() == 0
    assert langid.predict(docs.limit(0), models).count() == 0


def test_digests_of_the_query(spark, docs, tmp_path):
    from reelstat.llm.queries import op1_sentencepiece

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in op1_sentencepiece(spark, str(tmp_path)).collect()}
    assert out[1].ids_sha256 == hashlib.sha256(b"").hexdigest() == out[2].decoded_sha256
    assert out[5].decoded_sha256 == hashlib.sha256(PROSE.encode()).hexdigest()


# ---- rows that share an id and differ in text ----------------------------------------


def test_line_dedup_keeps_clean_lines_of_a_repeated_id(spark):
    texts = ["alpha line one here\nshared line of text here", "shared line of text here\nunique clean line nowhere else", "x y z\nalpha line one here"]
    docs = spark.createDataFrame([(5, texts[0]), (5, texts[1]), (9, texts[2]), (9, texts[2]), (None, "null id line of text")], "doc_id long, text string")
    got = [r.text for r in line_dedup.dedup_lines(docs).collect()]
    kept = [line for t in got for line in t.split("\n") if line]
    assert sorted(kept) == sorted(["alpha line one here", "shared line of text here", "unique clean line nowhere else", "x y z", "x y z", "null id line of text"])


def test_near_duplicates_tell_rows_of_an_id_apart(spark):
    w, v = (" ".join(f"{c}{k}" for k in range(60)) for c in "wv")
    docs = spark.createDataFrame([(1, w + " end"), (2, w), (2, v), (3, v + " end"), (3, v + " end"), (None, "other")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.class_id or 0, r.links, r.kept) for r in bag_minhash.near_duplicates(docs).collect())
    assert got == [(0, 0, 0, True), (1, 1, 1, True), (2, 1, 1, False), (2, 2, 1, True), (3, 2, 1, False), (3, 2, 1, False)]
    assert sorted((r.doc_id or 0, r.text) for r in bag_minhash.one_of_each(docs).collect()) == [(0, "other"), (1, w + " end"), (2, v)]


def test_one_of_each_of_equal_rows_and_of_two_texts_under_the_least_id(spark):
    w = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, w), (1, w + " end"), (1, w), (4, w)], "doc_id long, text string")
    assert bag_minhash.one_of_each(docs).count() == 1
    assert {r.class_id for r in bag_minhash.near_duplicates(docs).collect()} == {1}


def test_license_labels_stay_with_their_row(spark):
    phrase = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
    docs = spark.createDataFrame([(1, phrase), (1, "plain text without anything"), (2, None)], "doc_id long, text string")
    got = {r.n_words: r for r in license_scan.scan(docs).collect()}
    assert got[4].labels == "" and got[4].score == 0.0 and got[len(phrase.split())].labels == "mit"
