import glob

from conftest import SF_SMALL
from reelstat.operators import profile, splits
from reelstat.sources import text
from reelstat.sources.tables import ratings


def test_numeric_lines(spark, tmpdir_fresh):
    p = f"{tmpdir_fresh}/n.txt"
    with open(p, "w") as f:
        f.write("1.5\nabc\n3\n")
    got = [r.value for r in text.read_numeric_lines(spark, p).orderBy("row_no").collect()]
    assert got == [1.5, None, 3.0]


def test_report_append(spark, tmpdir_fresh):
    r = ratings(spark, SF_SMALL)
    out = f"{tmpdir_fresh}/report"
    splits.write_report(splits.split_report(r), out)
    splits.write_report(splits.split_report({"again": r}), out)
    rows = spark.read.parquet(out).collect()
    assert sorted(x.source for x in rows) == ["again", "ratings"] and all(x.entries == 6000 for x in rows)


def test_summary_csv(spark, tmpdir_fresh):
    r = ratings(spark, SF_SMALL).where("category = 4")
    out = f"{tmpdir_fresh}/summary"
    profile.write_summary_csv(profile.movie_summary(r), out)
    lines = open(glob.glob(f"{out}/part-*.csv")[0]).read().splitlines()
    header = lines[0].split(",")
    assert header[:6] == ["movie", "ratings", "rating_mean", "rating_var", "first_rating", "last_rating"]
    assert len(header) == 26
    assert all(len(x.split(".")[-1]) == 3 for x in lines[1].split(",")[2:4])


def test_prediction_file_in_input_order(spark, tmpdir_fresh):
    df = spark.createDataFrame([(2, 4.0), (0, 1.25), (1, 5.0)], "row_no long, prediction double")
    out = f"{tmpdir_fresh}/pred"
    text.write_predictions(df, out)
    lines = []
    for f in sorted(glob.glob(f"{out}/part-*")):
        lines += open(f).read().splitlines()
    assert lines == ["1.25000", "5.00000", "4.00000"]


def test_score_file_job(spark, tmpdir_fresh):
    from reelstat.operators import model as M
    from reelstat.plans.scoring import score_file, true_rating_file

    r = ratings(spark, SF_SMALL)
    model_path = f"{tmpdir_fresh}/model"
    M.init_model(r, 3).write.parquet(model_path)
    ids = r.select("user_id", "movie_id").limit(2).collect()
    rows = spark.createDataFrame([(i, x.user_id, x.movie_id, 3) for i, x in enumerate(ids)],
                                 "row_no long, user_id long, movie_id int, rating int")
    score_file(spark, model_path, rows, 3.0, f"{tmpdir_fresh}/pred", k=3)
    lines = []
    for f in sorted(glob.glob(f"{tmpdir_fresh}/pred/part-*")):
        lines += open(f).read().splitlines()
    assert len(lines) == 2 and all(1.0 <= float(x) <= 5.0 and len(x.split(".")[1]) == 5 for x in lines)
    true_rating_file(rows, f"{tmpdir_fresh}/true")
    got = []
    for f in sorted(glob.glob(f"{tmpdir_fresh}/true/part-*")):
        got += open(f).read().splitlines()
    assert got == ["3.00000", "3.00000"]


def test_clear_scratch_only_touches_own_folders(spark, tmpdir_fresh):
    import os

    from reelstat.session import clear_scratch

    for name in ("reelstat-tables", "reelstat-runs", "other-job"):
        os.makedirs(f"{tmpdir_fresh}/{name}/x")
    removed = clear_scratch(spark, root=tmpdir_fresh)
    assert removed == [f"{tmpdir_fresh}/reelstat-tables"]
    assert sorted(os.listdir(tmpdir_fresh)) == ["other-job", "reelstat-runs"]
