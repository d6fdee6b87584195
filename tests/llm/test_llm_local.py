"""The operators' task-side code against the library, exact formulas and plain versions; no Spark session."""

import base64
import collections
import hashlib
import random

import numpy as np
import pytest
import zstandard

import public_tokenizers
import sentencepiece
from reelstat.llm import bag_minhash, decontaminate, html_extract, katz_lm, langid, quality_zstd, shingles, warc
from reelstat.llm.sentencepiece_codec import Vocabulary

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    with open(MODEL, "rb") as f:
        return Vocabulary(f.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


UNITS = [*"  ▁\n\t aebiontshr.,<>0xA/|#='", "é", "ß", "ﬁ", "𝒳", "​", "\x00", "中", "한", "the", "ing", " the", "====", "    "]


def test_encoding_is_the_librarys(vocabulary, library):
    rng = random.Random(5)
    texts = ["".join(rng.choices(UNITS, k=rng.randint(0, 40))) for _ in range(4000)]
    texts += ["", " ", "a" * 3000, " " * 2000, "=" * 777, "x" + "\n" * 50, "thtionhe" * 400]
    for text in texts:
        ids = library.encode(text)
        assert vocabulary.encode(text) == ids
        assert vocabulary.decode(ids) == library.decode(ids)


def test_decoding_of_any_ids_is_the_librarys(vocabulary, library):
    rng = random.Random(6)
    for _ in range(4000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000), rng.randrange(5), 28705]) for _ in range(rng.randint(0, 9))]
        assert vocabulary.decode(ids) == library.decode(ids)


def multiset_similarity(a, b, n=5):
    def bag(text):
        w = text.split()
        return collections.Counter(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else collections.Counter()

    x, y = bag(a), bag(b)
    keys = set(x) | set(y)
    return sum(min(x[k], y[k]) for k in keys) / sum(max(x[k], y[k]) for k in keys) if keys else 1.0


def test_bag_minhash_estimates_without_bias_and_overlap_is_exact():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    errors = []
    for _ in range(120):
        a = rng.choices(words, k=rng.randint(30, 300))
        b = list(a)
        for _ in range(rng.randint(0, 8)):
            b[rng.randrange(len(b))] = "other"
        b += b[: rng.randint(0, 30)] * rng.randint(0, 4)
        a, b = " ".join(a), " ".join(b)
        exact = multiset_similarity(a, b)
        assert shingles.overlaps([a], [b])[0] == pytest.approx(exact)
        signs = bag_minhash.signatures([a, b])
        errors.append((signs[0] == signs[1]).mean() - exact)
    assert abs(np.mean(errors)) < 0.012
    assert np.std(errors) < 0.05


def test_signatures_do_not_depend_on_the_batch_and_short_texts_have_one_shingle():
    texts = ["", "one", "one two three four", " \t ", "a b c d e f g", "a b c d e f g"]
    together = bag_minhash.signatures(texts)
    for k, text in enumerate(texts):
        assert (bag_minhash.signatures([text])[0] == together[k]).all()
    assert np.isinf(together[0]).all() and np.isinf(together[3]).all()
    assert (together[4] == together[5]).all()
    assert shingles.overlaps(["", "a b", "a"], ["", "a b", "b"]).tolist() == [1.0, 1.0, 0.0]


def test_hamming_index_finds_all_within_the_radius():
    rng = np.random.default_rng(3)
    items = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    index = decontaminate.HammingIndex(items)
    for _ in range(150):
        probe = items[rng.integers(60)]
        for bit in rng.choice(64, rng.integers(0, 26), replace=False):
            probe ^= np.uint64(1) << np.uint64(bit)
        expected = np.flatnonzero(np.bitwise_count(items ^ probe) <= decontaminate.RADIUS)
        assert index.near(probe).tolist() == expected.tolist()


def test_kneser_ney_probabilities_sum_to_one():
    samples = {"x": ["abra cadabra " * 20, "cab bad dab"] * 6, "y": ["lorem ipsum dolor " * 15, "sum more"] * 6}
    models = langid.fit(samples)
    seen = np.unique(np.concatenate([langid.characters(t) for v in samples.values() for t in v]))
    alphabet = np.concatenate((seen, [np.uint32(0x3B1)]))  # and one that stands for all unseen characters
    for context in ("bra", "lor", "zzz", "   "):
        before = np.array([ord(c) for c in context], np.uint32)
        grams = np.stack([np.concatenate((before, [c])) for c in alphabet])
        assert np.exp2(models._lookup(grams)).sum(axis=0) == pytest.approx(1.0, abs=1e-4)
    best, score, _, rejected = models.judge([langid.characters(t) for t in ("abracadabra", "ipsum lorem", "123 !?", "")])
    assert [models.languages[k] if k >= 0 else None for k in best] == ["x", "y", None, None]
    assert ((0 <= score) & (score <= 1)).all() and rejected.tolist()[2:] == [True, True]


def test_good_turing_discounts_stay_between_zero_and_the_count():
    for frequencies in ({}, {1: 5}, {1: 100, 2: 40, 3: 20, 4: 12, 5: 8, 6: 6}, {2: 3, 6: 1}, {1: 1, 6: 9}):
        kept = katz_lm.discounts(frequencies)
        assert all(0 < v < r for r, v in kept.items())


def test_quality_counts_against_plain_versions():
    rng = random.Random(2)
    for _ in range(300):
        words = rng.choices(["a", "b", "c", "dd"], k=rng.randint(0, 25))
        windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
        assert quality_zstd.repeated_words(words) == len(covered)
    assert quality_zstd.repeated_lines("a\n\na\n \n \nb\na") == 2
    compressor = zstandard.ZstdCompressor(level=3)
    noise = bytes(rng.randrange(256) for _ in range(20_000))
    assert quality_zstd.compression(noise, compressor)[3].startswith("incompressible")
    assert quality_zstd.compression(b"the same words again " * 2000, compressor)[3].startswith("repetitive")
    assert quality_zstd.compression(b"", compressor) == (0.0, 0.0, 0.0, "empty")


def test_loser_tree_merges_like_a_sort():
    rng = random.Random(4)
    for k in range(12):
        runs = [sorted(rng.randint(0, 40) for _ in range(rng.randint(0, 15))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("http://www.A.example.com:80/X?b=1#top") == "com,example,a)/x?b=1"
    assert warc.url_key("https://user@h.org:8080") == "org,h:8080)/"
    assert warc.url_key("") == "" and warc.url_key("no url") == "no url"


def test_archive_records_are_checked():
    payload = "<p>é</p>\r\n\r\n".encode()
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    head = (
        f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nWARC-Date: 2024-01-01T00:00:07Z\r\n"
        f"WARC-Target-URI: http://a.b/\r\nWARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    data = head.encode() + block + b"\r\n\r\n"
    assert warc.index_archive(data * 2, "x")[1][:4] == (7, "b,a)/", "20240101000007", len(payload))
    with pytest.raises(warc.BadArchive):
        warc.index_archive(data.replace(b"<p>", b"<q>"), "x")
    with pytest.raises(warc.BadArchive):
        list(warc.records(data[:-3]))


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var x="</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy</div><!-- c --><header>Top</header>
<article><h1>A &amp;  B</h1><p><b>One<br><p>two &eacute;
 three</p><div class="comments"><p>nice</p></div><form>f</form></article><aside>s</aside><footer>&copy; me</footer></body></html>"""


def test_main_text_of_a_page():
    template = frozenset({"/html", "/html/body", "/html/body/article"})
    assert html_extract.main_text(PAGE, template) == "A & B\nOne\ntwo é three"
    assert html_extract.main_text(PAGE, frozenset()) == "A & B\nOne\ntwo é three"
    assert html_extract.main_text("", template) == ""
    assert html_extract.main_text("plain &lt; text", frozenset()) == "plain < text"
    plain = "<body><div id='menu'>m</div><div>Same notice</div><div class='x'>Body <i>te</i>xt</div><div id=cookie-notice>c</div>"
    same = html_extract._text_key("/body/div", "Same notice")
    assert html_extract.main_text(plain, frozenset({same})) == "Body text"
    assert html_extract.main_text("<p>a < b and <!-- open", frozenset()) == "a < b and"


def test_nested_classes_need_their_enclosing_elements():
    assert html_extract.nested(["/html", "/html/body", "/html/body/article", "/x/y", "/html/body#1", "/x#2"]) == frozenset(
        {"/html", "/html/body", "/html/body/article", "/html/body#1"}
    )
