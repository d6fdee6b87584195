"""Token counts, phrases and ranked search against the library, plain counting and full scoring."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from reelstat.llm import collocations, filters, queries, ranked_search, token_counts

LOWER = {c: c + 32 for c in range(65, 91)}
DOC = "doc_id long, text string, lang string, digest string, n_tokens int, score string, rank string, f string"


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, "y", "z", "f") for r in rows], DOC)


# ---- token counts -------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=queries.tokenizer_path())


def test_token_counts_against_the_library(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op12_token_counts(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for d in docs:
        n = len(library.encode(d.text or ""))
        assert (got[d.doc_id].n_bytes, got[d.doc_id].n_tokens, got[d.doc_id].over_limit) == (len((d.text or "").encode()), n, n > 4096)


def test_cache_encodes_only_what_it_lacks(spark, library, tmp_path, monkeypatch):
    encoded = []
    real = token_counts.encode_counts
    monkeypatch.setattr(token_counts, "encode_counts", lambda texts, model: (encoded.append(sorted(r.text for r in texts.collect())), real(texts, model))[1])
    cache, path = f"{tmp_path}/cache", queries.tokenizer_path()
    rows = [(1, "some text", "en"), (2, "some text", "en"), (3, None, None), (4, "", "en"), (5, "a▁b", "en"), (6, "a b", "en")]
    first = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame(spark, rows), path, cache).collect()}
    assert encoded == [["", "a▁b", "some text"]]  # the space mark is a space to the model, null is empty
    assert first == {i: len(library.encode(t or "")) for i, t, _ in rows}
    more = [*rows, (1, "another text of the same id", "en"), (None, "some text", "en"), (None, "without an id", "en"), (7, "x" * 300_000, "en")]
    second = token_counts.count_tokens(frame(spark, more), path, cache).collect()
    assert encoded[1:] == [["another text of the same id", "without an id", "x" * 300_000]]
    assert sorted(r.n_tokens for r in second) == sorted(len(library.encode(t or "")) for _, t, _ in more)
    token_counts.count_tokens(frame(spark, more), path, cache).collect()
    assert len(encoded) == 2
    monkeypatch.setattr(token_counts, "RULE", "another rule")
    monkeypatch.setattr(token_counts.tokenizer_version, "__defaults__", ("another rule",))
    token_counts.count_tokens(frame(spark, rows), path, cache).collect()
    assert encoded[2] == encoded[0]  # another version never meets old counts
    assert spark.read.parquet(cache).groupBy("tokenizer").count().count() == 2


def test_token_counts_of_hot_texts_and_no_rows(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(token_counts, "HOT_SHARE", 4)
    rows = [(i, "the same" if i % 2 else f"text {i}", "en") for i in range(40)]
    got = token_counts.count_tokens(frame(spark, rows), queries.tokenizer_path(), f"{tmp_path}/a").collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == [(i, len(library.encode(t))) for i, t, _ in rows]
    none = token_counts.count_tokens(frame(spark, rows).where("false"), queries.tokenizer_path(), f"{tmp_path}/b")
    assert none.columns == ["doc_id", "n_bytes", "n_tokens"] and none.collect() == []


# ---- phrases --------------------------------------------------------------------------


def words_of(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def plain_phrases(rows, top, least):
    f, total = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        for words in words_of(text):
            total[lang or "und"] += len(words)
            for n in (1, 2, 3):
                f.update((lang or "und", tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    out = collections.defaultdict(list)
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    for (lang, p), a in found.items():
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        longer = [b for (x, q), b in found.items() if x == lang and len(q) > len(p) and p in (q[:2], q[1:])]
        if not any(100 * b >= 50 * a for b in longer):
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, x, y, total[lang], -s)
        for lang, rows in out.items()
        for rank, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1)
    )


def test_phrases_against_plain_counting(spark):
    pick = random.Random(5)
    vocabulary = ["de", "en", "The", "the", "oř", "ab", "c\x00d", "'x", "en ", "zz"]
    rows = [(k, "".join(pick.choice(vocabulary) + pick.choice([" ", "  ", "\t", " ", " ", ". ", "\n", ";"]) for _ in range(60)), pick.choice(["de", "en", None]))
            for k in range(60)]
    rows += [(100 + k, "one passage that stands in many texts, word for word", "en") for k in range(25)]
    rows += [(200, None, "en"), (201, "", "fr"), (202, " .,; ", "fr"), (203, "alone", "fr"), (204, "the " * 5000, "en")]
    got = [tuple(r) for r in collocations.collocations(frame(spark, rows), top=40).collect()]
    assert sorted(got) == plain_phrases(rows, 40, 10)
    assert collocations.collocations(frame(spark, rows[:1]).where("false")).collect() == []


def test_phrases_with_full_filters_are_the_same(spark, monkeypatch):
    """A filter that lets everything through prunes nothing and changes nothing."""
    rows = [(k, "aa bb cc aa bb dd, aa bb", "en") for k in range(9)] + [(k, f"w{k} aa bb cc", "en") for k in range(9, 30)]
    want = plain_phrases(rows, 50, 10)
    monkeypatch.setattr(collocations, "build_filter", lambda numbers: np.full(filters.FILTER_LONGS, -1, np.int64))
    assert sorted(tuple(r) for r in collocations.collocations(frame(spark, rows), top=50).collect()) == want


def test_chunks_depend_on_their_words_only():
    pick = random.Random(4)
    passage = " ".join("".join(pick.choice("abcdefghij") for _ in range(pick.randint(2, 9))) for _ in range(400))
    a = collocations.chunks_of(pa.array(["some start " + passage + " and an end"]))[0].to_pylist()
    b = collocations.chunks_of(pa.array(["quite another beginning of it, " + passage]))[0].to_pylist()
    assert len(set(a) & set(b)) >= 400 // collocations.TRIGGER // 2
    whole = [w for c in a for w in c.split("\t")[0].split(" ")]
    assert whole == ["some", "start", *passage.split(), "and", "an", "end"]


# ---- ranked search -------------------------------------------------------------------


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_search(docs, items, top=10):
    bags = [(i, collections.Counter(terms_of(t))) for i, t, *_ in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, length = sum(n > 0 for n in sizes), sum(sizes)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for (i, b), n in zip(bags, sizes):
            m = 10 + (90 * n * n_docs) // max(length, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in set(terms_of(text)) if b[t])
            if s > 0:
                scored.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def corpus(seed, n):
    pick = random.Random(seed)
    common, rare = ["the", "of", "de", "Ünd", "a1"], [f"w{k}" for k in range(300)]
    docs = [(i, " ".join(pick.choice(common if pick.random() < 0.5 else rare) for _ in range(pick.randint(1, 60))), "en") for i in range(n)]
    return docs + [(n, None, "en"), (n + 1, "", "en"), (n + 2, "-- !", "en"), (n + 3, docs[3][1], "en"), (n + 4, docs[3][1] * 400, "en")]


def test_search_against_full_scoring(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_POSTINGS", 700)
    monkeypatch.setattr(ranked_search, "ITEM_BYTES", 200)
    docs = corpus(1, 300)
    items = [(k, d[1][:90]) for k, d in enumerate(docs[:25])] + [(90, None), (91, "..."), (92, "the"), (93, "nowhere to be found zzz"), (94, "the the of OF")]
    got = ranked_search.search(frame(spark, docs), spark.createDataFrame([*items, items[0]], "item_id long, text string"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain_search(docs, items)


def test_search_of_repeated_ids_and_empty_tables(spark):
    docs = [(1, "alpha beta", "en"), (1, "alpha gamma", "en"), (None, "alpha alpha", "en"), (2, "delta", "en"), (2, "delta", "en")]
    items = spark.createDataFrame([(1, "alpha"), (2, "delta")], "item_id int, text string")
    got = ranked_search.search(frame(spark, docs), items).collect()
    assert [(r["rank"], r.doc_id) for r in got if r.item_id == 1] == [(1, None), (2, 1), (3, 1)]
    assert [(r["rank"], r.doc_id) for r in got if r.item_id == 2] == [(1, 2), (2, 2)]
    assert ranked_search.search(frame(spark, docs).where("false"), items).collect() == []
    assert ranked_search.search(frame(spark, docs), items.where("false")).collect() == []


def test_pair_bounds_look_at_fewer_documents(spark):
    docs = corpus(2, 2000)
    q = ranked_search.Queries.of([(0, "w1 w2 w3 w4 w5 w6 w7 w8 the of"), (1, docs[5][1])])
    blocks = ranked_search.index_blocks(frame(spark, docs).select("doc_id", "text").where("text <> ''"), q.vocabulary)
    w = ranked_search.corpus_weights(blocks, len(q.vocabulary))
    pairs, groups = ranked_search.pair_off(q, w)
    index = ranked_search.pair_lists(blocks, w, pairs)
    floor = ranked_search.thresholds(index, w, groups, 10)
    looked = [0, 0]
    for row in index.toArrow().to_batches():
        for k in range(row.num_rows):
            block = ranked_search.Block([row.column(c)[k].values.to_numpy() for c in range(len(ranked_search.IMPACTS))], w)
            for mine, least in zip(groups, floor):
                with_pairs, alone = (ranked_search.evaluate(mine, block, w.weight, max(1, int(least)), use) for use in (True, False))
                assert with_pairs[0].tolist() == alone[0].tolist() and with_pairs[1].tolist() == alone[1].tolist()
                looked[0] += with_pairs[2]
                looked[1] += alone[2]
    assert looked[0] < looked[1]


def test_queries_on_the_small_tables(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(tuple(r) for r in queries.op13_ranked_search(spark, SF_SMALL).collect()) == plain_search(docs, items)
    assert sorted(tuple(r) for r in queries.op11_collocations(spark, SF_SMALL).collect()) == plain_phrases(docs, 2000, 10)
