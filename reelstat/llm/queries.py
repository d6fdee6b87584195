"""The registered queries of the corpus operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.llm import (
    bag_minhash,
    collocations,
    decontaminate,
    html_extract,
    katz_lm,
    langid,
    license_scan,
    line_dedup,
    quality_zstd,
    ranked_search,
    sentencepiece_codec,
    token_counts,
    warc,
)
from reelstat.llm.common import table

TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded, then decoded from its ids; digests of both."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_codec.encode(docs, tokenizer_path())
    back = sentencepiece_codec.decode(coded, tokenizer_path(), text_col="decoded")
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that another line of the corpus stands for."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of every document; learned from those that are not held out."""
    return katz_lm.score(table(spark, sf_dir, "documents"), held_out(7, 2))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases, template labels and scores of every document."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, compression ratios and the verdict of every document."""
    return quality_zstd.score_quality(table(spark, sf_dir, "documents"))


def op6_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return bag_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, with the most similar window."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back, in the order of the capture histories."""
    return warc.capture_histories(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "timestamp", "shard", "position"
    )


def held_out(modulus: int, remainder: int):
    return F.crc32(F.col("doc_id").cast("string")) % modulus == remainder


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; learned from rows whose id hash does not mark them as held out."""
    docs = table(spark, sf_dir, "documents")
    models = langid.learn(docs.where(~held_out(5, 0)))
    return langid.predict(docs, models).select(
        "doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score", "bits", "rejected"
    )


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two or three words of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


TOKEN_LIMIT = 4096


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, through a cache that starts out empty."""
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), token_counts.fresh_cache(spark))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_line_dedup": op2_line_dedup,
    "op3_katz": op3_katz,
    "op4_licenses": op4_licenses,
    "op5_quality": op5_quality,
    "op6_near_dups": op6_near_dups,
    "op7_decontaminate": op7_decontaminate,
    "op8_warc": op8_warc,
    "op9_langid": op9_langid,
    "op10_html": op10_html,
    "op11_collocations": op11_collocations,
    "op12_token_counts": op12_token_counts,
    "op13_ranked_search": op13_ranked_search,
}

COLLOCATIONS_SQL = r"""WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
  string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
pieces AS (SELECT lang, unnest(ps) AS p FROM docs),
ws AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
tot AS (SELECT lang, sum(len(w))::BIGINT AS n FROM ws GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM ws, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 10),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT c.*, j, array_to_string(w[1:j], ' ') AS lp, array_to_string(w[j + 1:k], ' ') AS rp FROM c, (VALUES (1), (2)) AS s(j) WHERE j < k),
sc AS (SELECT cuts.lang, cuts.phrase, cuts.k, a, j, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lp AND x.k = j JOIN f y ON y.lang = cuts.lang AND y.phrase = rp AND y.k = cuts.k - j),
low AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ins AS (SELECT lang, phrase, max(a) AS longer FROM (
  SELECT lang, a, array_to_string(w[1:2], ' ') AS phrase FROM c WHERE k = 3 UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM c WHERE k = 3) GROUP BY lang, phrase),
kept AS (SELECT low.* FROM low LEFT JOIN ins USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN tot USING (lang) WHERE rank <= 2000"""

SEARCH_SQL = r"""WITH doc AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents WHERE text IS NOT NULL),
d AS (SELECT d, doc_id, len(t)::BIGINT AS n, t FROM doc WHERE len(t) > 0),
k AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM d),
tf AS (SELECT d, term, count(*)::BIGINT AS tf FROM (SELECT d, unnest(t) AS term FROM d) GROUP BY d, term),
it AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE text IS NOT NULL),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM tf WHERE term IN (SELECT term FROM it) GROUP BY term), k),
p AS (SELECT tf.d, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))) AS s FROM tf JOIN w USING (term) JOIN d USING (d), k),
r AS (SELECT item_id, d, sum(s)::BIGINT AS score FROM it JOIN p USING (term) GROUP BY item_id, d)
SELECT item_id, rank, doc_id, score FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM r JOIN d USING (d) WHERE score > 0) WHERE rank <= 10"""

ORACLES: dict[str, str] = {"op11_collocations": COLLOCATIONS_SQL, "op13_ranked_search": SEARCH_SQL}
