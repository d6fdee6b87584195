"""The corpus operators on inputs where a part of the work could be left out unseen."""

import collections
import random

import pytest

from conftest import SF_SMALL
from pyspark.sql import functions as F

from reelstat.llm import html_extract, langid, license_scan, line_dedup, linking, shingles
from reelstat.llm.common import written
from test_llm_brute import SPACE, union


def line_classes(lines):
    """Classes of all pairs of lines with Jaccard similarity 0.8 of their character shingles, as a root per line."""
    sets = [frozenset(x[i : i + 12] for i in range(max(1, len(x) - 11))) for x in lines]
    by_shingle = collections.defaultdict(list)
    find, join = union(len(lines))
    for i, s in enumerate(sets):
        for j, common in collections.Counter(j for x in s for j in by_shingle[x]).items():
            if common >= 0.8 * (len(s) + len(sets[j]) - common):
                join(i, j)
        for x in s:
            by_shingle[x].append(i)
    return [find(i) for i in range(len(lines))]


def unspaced_lines():
    rng = random.Random(3)
    urls = [f"https://www.{rng.choice('abcdef')}{rng.randrange(10**9)}.example/{rng.randrange(10**12)}" for _ in range(40)]
    codes = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789+/", k=90)) for _ in range(20)]
    cjk = ["今天的天气预报和新闻报道说" + "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(60)) for _ in range(20)]
    smileys = ["".join(chr(rng.randrange(0x1F600, 0x1F640)) for _ in range(70)) for _ in range(10)]
    return [*urls, *codes, *cjk, *smileys, *["x" + c[1:] for c in codes], *["上" + c[1:] for c in cjk], *[c[:-1] + "終" for c in smileys]]


@pytest.mark.parametrize("source", ["unspaced", "documents"])
def test_line_dedup_by_all_character_shingles(spark, source):
    if source == "unspaced":
        docs = spark.createDataFrame([(k, x) for k, x in enumerate(unspaced_lines())], "doc_id long, text string")
    else:
        docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    first = {}
    for d in sorted(texts):
        for line in texts[d].split("\n"):
            if line.lower().strip(SPACE):
                first.setdefault(line.lower().strip(SPACE), d)
    lines = list(first)
    roots = line_classes(lines)
    owner = {}
    for line, root in zip(lines, roots):
        owner[root] = min(owner.get(root, first[line]), first[line])
    if source == "unspaced":
        assert len(owner) == 90
    root_of = dict(zip(lines, roots))
    kept = [(root_of[x], d) for d, t in got.items() for x in (y.lower().strip(SPACE) for y in t.split("\n")) if x]
    assert sorted(kept) == sorted(owner.items())


def test_a_large_bucket_of_many_families(spark):
    """Chains of near copies of five families, all in one bucket: no end of a chain is near its hub."""
    rng = random.Random(5)
    sets = {}
    for family in range(5):
        tokens = [1000 * family + k for k in range(40)] + [7_000_000 + k for k in range(10)]
        for k in range(12):
            tokens = [x if j != k * 3 % 40 and j != (k * 3 + 1) % 40 else rng.randrange(1 << 40) for j, x in enumerate(tokens)]
            sets[100 * family + k] = frozenset(tokens)
    find, join = union(len(sets))
    ids = sorted(sets)
    near = {(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    for a, b in near:
        join(ids.index(a), ids.index(b))
    table = written(spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id long, set array<long>"), "test-sets")
    members = written(table.select(F.lit(1).cast("long").alias("h"), "id", F.size("set").alias("size")), "test-members")
    similar = written(spark.createDataFrame(sorted(near), "a long, b long"), "test-similar")
    _, classes = linking.link_classes(
        members,
        lambda pairs: pairs.join(similar, ["a", "b"], "left_semi"),
        0.8,
        2,
        tokens=lambda wanted: table.join(wanted, "id").select("id", F.explode("set").alias("token")),
    )
    root = {r.node: r.root for r in classes.collect()}
    assert {i: root.get(i, i) for i in ids} == {i: ids[find(k)] for k, i in enumerate(ids)}


def test_occurrence_numbers_keep_the_multiset():
    texts = ["a b c d e a b c d e a b c d e", "a b c d e a b c d e x", "short", ""]
    owner, number = shingles.occurrences(texts)
    sets = [set(number[owner == k]) for k in range(4)]
    assert [len(s) for s in sets] == [11, 7, 1, 0]
    common = len(sets[0] & sets[1])
    assert common / (18 - common) == pytest.approx(shingles.overlaps(texts[:1], texts[1:2])[0])


def test_tokens_of_equal_share_count_as_template_by_their_vectors(spark):
    """Two texts on half of a host's pages: template where they stand on the same pages, else content."""
    body = "<html><body><div>own {0}</div>{1}</body></html>"
    first, second = "<div>Text one</div>", "<div>Text two</div>"
    together = [body.format(k, (first + second) if k < 3 else "") for k in range(6)]
    apart = [body.format(k, first * (k < 3) + second * (k > 2)) for k in range(6)]
    copies = ["<html><body><div>All of it</div></body></html>"] * 2
    data = [(10 * h + k, f"http://h{h}/{k}", x) for h, pages in enumerate((together, apart, copies)) for k, x in enumerate(pages)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in range(6)] == [f"own {k}" for k in range(6)]
    assert [got[10 + k] for k in range(6)] == [f"own {k}\nText {'one' if k < 3 else 'two'}" for k in range(6)]
    assert got[20] == got[21] == "All of it"


def test_classes_are_nested_by_their_enclosing_class():
    page = ["/html", "/html/body", "/html/body/ul", "/html/body/div.a"]
    assert html_extract.template_of([page, ["/html/body/ul/li", "/html/body/div.a/p"]]) == frozenset([*page, "/html/body/ul/li", "/html/body/div.a/p"])
    box = ["/html/body/div.a/b", "/html/body/div.a/b/i"]
    far = ["/html/body/div.a/b/i/u", "/html/body/ul/li"]
    assert html_extract.template_of([page, box, far]) == frozenset([*page, *box])


@pytest.mark.parametrize("wrapped", [
    "<body class='has-sidebar'>{}</body>",
    "<body class='no-sidebar modal menu'>{}</body>",
    "<body><div class='navbar-fixed ad-free'>{}</div></body>",
    "<body><div class='page social-share'>{}</div></body>",
    "<body><form id=aspnetForm>{}</form></body>",
    "<body><form><div class='widget social'>{}</div></form></body>",
])
@pytest.mark.parametrize("article", ["article", "article class='ad-free'", "article class=social", "div role=main", None])
def test_wrappers_of_the_page_are_kept(wrapped, article):
    menu = "<nav>Home</nav><div class='site-footer'>imprint</div><div class=comments><article>reply</article></div>"
    main = f"<{article}><p>Main text</p></{article.split()[0]}>" if article else "<p>Main text</p>"
    if article is None and "widget social" in wrapped:
        pytest.skip("nothing but dropped names around the text")
    assert html_extract.main_text("<html>" + wrapped.format(menu + main), frozenset()) == "Main text"


def test_dropped_elements_stay_dropped():
    for inside in ("<div class=menu>m</div>", "<div id='cookie-notice'>c</div>", "<div class='main-nav left'>n</div>", "<aside><article>a</article></aside>"):
        assert html_extract.main_text(f"<body>{inside}<p>Text</p>", frozenset()) == "Text"
        assert html_extract.main_text(f"<body>{inside}<article>Text</article>", frozenset()) == "Text"


def test_a_file_of_many_licenses_gets_every_label(spark):
    """All templates word for word in one file; in another, one of them among the words of all others."""
    notices = "\n\n".join(f"Part {k}: {text}." for k, (_, text, _) in enumerate(license_scan.TEMPLATES))
    others = " ".join(sorted({w for _, text, _ in license_scan.TEMPLATES for w in text.split()}, reverse=True))
    data = [(1, notices), (2, others + "\n" + license_scan.TEMPLATES[7][1]), (3, "plain text")]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got[1].labels == ",".join(sorted({label for label, _, _ in license_scan.TEMPLATES}))
    assert "cc-by-sa" in got[2].labels.split(",") and got[3].labels == ""


def test_every_label_is_learned_and_no_label_rejects_nothing(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_CHARS", 300_000)
    data = [(k, chr(0x4E00 + 3 * k) + chr(0x4E01 + 3 * k), f"l{k:03}") for k in range(220)]
    data += [(1000, "wort " * 1_000, "long")]
    docs = spark.createDataFrame([(d, (t + " ") * 20, lang) for d, t, lang in data], "doc_id long, text string, lang string")
    sample = langid.training_sample(docs)
    assert set(sample) == {lang for _, _, lang in data}
    assert all(len(t) <= 300_000 // 221 for texts in sample.values() for t in texts)
    models = langid.learn(docs)
    assert {r.doc_id: r.lang_pred for r in langid.predict(docs, models).collect()} == {d: lang for d, _, lang in data}
    plain = spark.createDataFrame([(1, "Text", None), (2, "12 !", None), (3, None, None)], "doc_id long, text string, lang string")
    assert langid.learn(plain) is None
    assert [r.doc_id for r in langid.drop_rejected(plain, None).collect()] == [1]


@pytest.mark.parametrize("limit", [10**9, 0])
def test_pages_meet_their_template_however_it_is_joined(spark, monkeypatch, limit):
    """Broadcast, or dealt out by host with the large hosts in parts: the same text."""
    monkeypatch.setattr(html_extract, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(html_extract, "HOSTS", 5)
    page = "<html><body><div class=top>Same here</div><p>Shared words</p><div>own {0}</div></body></html>"
    data = [(k, f"http://h{0 if k % 3 else k}/{k}", page.format(k)) for k in range(40)] + [(90, None, None), (91, "http://h0/", None)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert len(got) == 42 and got[90] == got[91] == ""
    for k in range(40):
        assert got[k] == (f"own {k}" if k % 3 or k == 0 else f"Same here\nShared words\nown {k}")
