import os
import struct

from reelstat.operators import positional
from reelstat.sources import binary, text


def _write_bin(path, recs, tail=b""):
    with open(path, "wb") as f:
        for r in recs:
            f.write(struct.pack("<IHHBB", *r))
        f.write(tail)


def test_binary_partial_tail_and_positions(spark, tmpdir_fresh):
    recs = [(i + 1, (i * 7) % 100 + 1, i % 300, i % 5 + 1, i % 6 + 1) for i in range(997)]
    os.makedirs(f"{tmpdir_fresh}/b")
    _write_bin(f"{tmpdir_fresh}/b/a.bin", recs[:500])
    _write_bin(f"{tmpdir_fresh}/b/b.bin", recs[500:], tail=b"\x01\x02\x03")
    df = binary.read_ratings_bin(spark, f"{tmpdir_fresh}/b", split_bytes=330)
    assert df.rdd.getNumPartitions() > 4
    got = sorted(df.collect(), key=lambda r: r.row_no)
    assert [tuple(r)[:5] for r in got] == recs
    assert [r.row_no for r in got] == list(range(997))


def test_binary_roundtrip_and_category_filter(spark, tmpdir_fresh):
    recs = [(i + 1, i % 50 + 1, i, 5, i % 6 + 1) for i in range(300)]
    _write_bin(f"{tmpdir_fresh}/in.bin", recs)
    df = binary.read_ratings_bin(spark, f"{tmpdir_fresh}/in.bin")
    binary.write_ratings_bin(df.orderBy("row_no"), f"{tmpdir_fresh}/out")
    back = binary.read_ratings_bin(spark, f"{tmpdir_fresh}/out")
    assert [tuple(r)[:5] for r in sorted(back.collect(), key=lambda r: r.row_no)] == recs
    assert binary.read_ratings_bin(spark, f"{tmpdir_fresh}/out", category=4).count() == 50


def test_text_blank_line_stops(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/d.txt"
    with open(p, "w") as f:
        f.write("1 2 3 4\n5 6 7 5\n9 10 11 1\n\n13 14 15 1\n16 17 18 2\n")
    assert text.read_rating_text(spark, p).count() == 3


def test_index_exhausted_is_train_6(spark, tmpdir_fresh):
    d, i = f"{tmpdir_fresh}/d.txt", f"{tmpdir_fresh}/i.txt"
    with open(d, "w") as f:
        f.write("".join(f"{k} 1 2 3\n" for k in range(5)))
    with open(i, "w") as f:
        f.write("4\n5\n1\n")
    got = [r.category for r in text.read_split_input(spark, d, i).orderBy("row_no").collect()]
    assert got == [4, 5, 1, 6, 6]


def test_number_lines_across_splits(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/big.txt"
    with open(p, "w") as f:
        f.write("".join(f"{k} 1 2 3\n" for k in range(30000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        r = text.read_rating_text(spark, p)
        assert r.rdd.getNumPartitions() > 10
        assert r.where("row_no != user_id").count() == 0 and r.count() == 30000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_chunk_writer(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/lines.txt"
    with open(p, "w") as f:
        f.write("".join(f"line{k}\n" for k in range(23)))
    text.write_chunks(spark, p, f"{tmpdir_fresh}/chunks", chunk=10)
    back = spark.read.text(f"{tmpdir_fresh}/chunks")
    counts = {r.chunk: r["count"] for r in back.groupBy("chunk").count().collect()}
    assert counts == {0: 10, 1: 10, 2: 3}
    assert sorted(r.value for r in back.where("chunk = 2").collect()) == ["line20", "line21", "line22"]


def test_number_by_and_first_n(spark):
    df = spark.createDataFrame([(k % 7, k) for k in range(200)], "a int, b int")
    n = positional.number_by(df, ["a", "b"]).orderBy("row_no").collect()
    assert [(r.a, r.b) for r in n] == sorted((k % 7, k) for k in range(200))
    assert [r.row_no for r in n] == list(range(200))


def test_prediction_lines_clamp(spark):
    from reelstat.functions.expressions import clamp

    df = spark.createDataFrame([(0, 5.7), (1, 0.2), (2, 3.123456)], "row_no long, x double")
    got = [r.line for r in text.prediction_lines(df.withColumn("prediction", clamp("x"))).orderBy("row_no").collect()]
    assert got == ["5.00000", "1.00000", "3.12346"]


def test_binary_pushdown_positions_and_category(spark, tmpdir_fresh):
    recs = [(i + 1, i % 50 + 1, i, i % 5 + 1, i % 6 + 1) for i in range(1000)]
    _write_bin(f"{tmpdir_fresh}/p.bin", recs)
    df = binary.read_ratings_bin(spark, f"{tmpdir_fresh}/p.bin", split_bytes=1000)
    first = df.where("row_no < 250")
    assert first.rdd.getNumPartitions() == 3          # only the byte ranges holding rows 0..249
    assert sorted(r.row_no for r in first.collect()) == list(range(250))
    mid = df.where("row_no >= 400 and row_no <= 402 and category = 5")
    assert [(r.row_no, r.category) for r in mid.collect()] == [(react, 5) for react in range(400, 403) if react % 6 + 1 == 5]
    cats = df.where("category in (2, 4)")
    assert cats.count() == sum(1 for r in recs if r[4] in (2, 4))


def test_malformed_line_is_null_not_failure(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/bad.txt"
    with open(p, "w") as f:
        f.write("1 2 3 4\nx 2 3 4\n5 6 7 8\n")
    got = [(r.user_id, r.rating) for r in text.read_rating_text(spark, p).orderBy("row_no").collect()]
    assert got == [(1, 4), (None, 4), (5, 8)]


def test_records_out_of_range_are_refused(spark, tmpdir_fresh):
    import pytest

    for row in ((1, 70000, 1, 1, 1), (1 << 33, 1, 1, 1, 1), (1, 1, -1, 1, 1), (1, None, 1, 1, 1)):
        df = spark.createDataFrame([row], "user_id long, movie_id int, date int, rating int, category int")
        with pytest.raises(Exception, match="rating record"):
            binary.write_ratings_bin(df, f"{tmpdir_fresh}/bad")
    narrowed = spark.createDataFrame([(1, 1, 1, 257, 258)], "user_id long, movie_id int, date int, rating int, category int")
    binary.write_ratings_bin(narrowed, f"{tmpdir_fresh}/p9")
    assert [(r.rating, r.category) for r in binary.read_ratings_bin(spark, f"{tmpdir_fresh}/p9").collect()] == [(1, 2)]


def test_append_keeps_rows_and_order(spark, tmpdir_fresh):
    schema = "user_id long, movie_id int, date int, rating int, category int"
    for user in (3, 1, 2):
        binary.write_ratings_bin(spark.createDataFrame([(user, 1, 1, 1, 1)], schema), f"{tmpdir_fresh}/a", mode="append")
    got = sorted(binary.read_ratings_bin(spark, f"{tmpdir_fresh}/a").collect(), key=lambda r: r.row_no)
    assert [r.user_id for r in got] == [3, 1, 2]


def test_parts_are_taken_in_the_order_of_their_numbers(spark, tmpdir_fresh):
    os.makedirs(f"{tmpdir_fresh}/b")
    os.makedirs(f"{tmpdir_fresh}/t")
    for k, name in enumerate(("part-2", "part-99999", "part-100000")):
        _write_bin(f"{tmpdir_fresh}/b/{name}.bin", [(k, 1, 1, 1, 1)])
        with open(f"{tmpdir_fresh}/t/{name}.txt", "w") as f:
            f.write(f"{k} 1 1 1\n")
    got = sorted(binary.read_ratings_bin(spark, f"{tmpdir_fresh}/b").collect(), key=lambda r: r.row_no)
    assert [r.user_id for r in got] == [0, 1, 2]
    assert [r.user_id for r in text.read_rating_text(spark, f"{tmpdir_fresh}/t").orderBy("row_no").collect()] == [0, 1, 2]


def test_blank_line_stops_its_own_file_only(spark, tmpdir_fresh):
    os.makedirs(f"{tmpdir_fresh}/t")
    for name, body in (("part-1", "1 1 1 1\n\n2 1 1 1\n"), ("part-2", "3 1 1 1\n4 1 1 1\n")):
        with open(f"{tmpdir_fresh}/t/{name}.txt", "w") as f:
            f.write(body)
    got = [(r.user_id, r.row_no) for r in text.read_rating_text(spark, f"{tmpdir_fresh}/t").orderBy("row_no").collect()]
    assert got == [(1, 0), (3, 3), (4, 4)]


def test_wide_records_keep_what_ten_bytes_cannot_hold(spark, tmpdir_fresh):
    schema = "user_id long, movie_id int, date int, rating int, category int"
    recs = [(i, 1, 1, 5, 1) for i in range(30)] + [(1 << 40, 70_000, -3, 257, 4), (7, 2_000_000, 90_000, 3, 258)] + [(2, 2, 2, 2, 2)]
    want = [(*r[:3], r[3] % 256, r[4] % 256) for r in recs]
    for n in (1, 3):
        df = spark.createDataFrame(recs, schema).coalesce(1) if n == 1 else spark.createDataFrame(recs, schema).repartitionByRange(n, "user_id")
        binary.write_ratings_bin(df, f"{tmpdir_fresh}/w{n}", wide=True)
        got = binary.read_ratings_bin(spark, f"{tmpdir_fresh}/w{n}", split_bytes=40)
        rows = sorted(got.collect(), key=lambda r: r.row_no)
        assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
        assert [r.row_no for r in rows] == list(range(len(recs)))
        assert [r.movie_id for r in got.where("category = 4").collect()] == [70_000]
    # without such rows the files are plain 10-byte records
    binary.write_ratings_bin(spark.createDataFrame(recs[:30], schema).coalesce(1), f"{tmpdir_fresh}/plain", wide=True)
    files = [f for f in os.listdir(f"{tmpdir_fresh}/plain") if f.endswith(".bin")]
    assert sum(os.path.getsize(f"{tmpdir_fresh}/plain/{f}") for f in files) == 300 and not any(".wide" in f for f in files)


def test_binary_queries_take_ids_beyond_a_record(spark, tmpdir_fresh):
    """A part key beyond u16 was an error of the three queries that store records."""
    from reelstat.plans.catalog import QUERIES

    spark.createDataFrame([(k, 60_000 + 6_000 * k, 1, 7.0, "1995-03-01") for k in range(6)],
                          "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, d string").selectExpr(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "cast(d as timestamp) l_shipdate").write.parquet(f"{tmpdir_fresh}/lineitem.parquet")
    spark.createDataFrame([(k, (1 << 33) + k) for k in range(6)], "o_orderkey long, o_custkey long").write.parquet(f"{tmpdir_fresh}/orders.parquet")
    assert {r[0] for r in QUERIES["binary_movie_summary"](spark, tmpdir_fresh).collect()} <= {60_000 + 6_000 * k for k in range(6)}
    assert sum(r.entries for r in QUERIES["binary_roundtrip"](spark, tmpdir_fresh).collect()) == 6
    assert sorted(r.movie_id for r in QUERIES["narrowed_records"](spark, tmpdir_fresh).collect()) == [60_000 + 6_000 * k for k in range(6)]
