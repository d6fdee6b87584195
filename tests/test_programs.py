"""End-to-end: text pairs → split records + report → summary CSV, dump, training, prediction."""

import glob
import os

from conftest import SF_SMALL
from reelstat.plans import fit, programs
from reelstat.sources.tables import ratings


def test_programs_end_to_end(spark, tmpdir_fresh):
    r = ratings(spark, SF_SMALL).orderBy("user_id", "movie_id", "date", "rating", "category").collect()
    pairs = []
    for n, chunk in enumerate((r[:4000], r[4000:])):
        d, i = f"{tmpdir_fresh}/all{n}.dta", f"{tmpdir_fresh}/all{n}.idx"
        with open(d, "w") as f:
            f.write("".join(f"{x.user_id} {x.movie_id} {x.date} {x.rating}\n" for x in chunk))
        with open(i, "w") as f:   # the second index is 100 lines short: those rows become train 6
            f.write("".join(f"{x.category}\n" for x in (chunk if n == 0 else chunk[:-100])))
        pairs.append((d, i))
    rep = {x.source: x for x in programs.split_job(spark, pairs, f"{tmpdir_fresh}/out", f"{tmpdir_fresh}/report").collect()}
    assert rep[pairs[0][0]].entries == 4000 and rep[pairs[1][0]].entries == 2000
    assert rep[pairs[1][0]].train_6 >= 100
    assert sum(x.entries for x in rep.values()) == 6000
    # records in input order per split: the train file of pair 0 holds its train rows in order
    train0 = [x for x in r[:4000] if x.category in (1, 2, 3, 6)]
    from reelstat.sources import binary
    got = sorted(binary.read_ratings_bin(spark, f"{tmpdir_fresh}/out/0.train").collect(), key=lambda x: x.row_no)
    assert [(x.user_id, x.movie_id, x.date, x.rating) for x in got] == [
        (x.user_id, x.movie_id, x.date, x.rating) for x in train0]

    summary = programs.summary_job(spark, f"{tmpdir_fresh}/out/0.train", f"{tmpdir_fresh}/summary")
    assert summary.count() > 0 and glob.glob(f"{tmpdir_fresh}/summary/part-*.csv")

    dump = programs.dump_job(spark, f"{tmpdir_fresh}/out/0", f"{tmpdir_fresh}/dump")
    assert dump.count() == 4000

    res = programs.train_job(spark, f"{tmpdir_fresh}/out/0.train", f"{tmpdir_fresh}/out/0.probe",
                             fit.FitConfig(run="prog", k=3, iterations=2, lr=0.001))
    rmse = programs.predict_job(spark, res.final_model, f"{tmpdir_fresh}/out/0.probe", f"{tmpdir_fresh}/out/0.test",
                                res.mu, f"{tmpdir_fresh}/pred", k=3)
    assert 0 < rmse < 5
    lines = sum((open(f).read().splitlines() for f in sorted(glob.glob(f"{tmpdir_fresh}/pred/part-*"))), [])
    n_test = sum(1 for x in r[:4000] if x.category == 5)
    assert len(lines) == n_test and all(1.0 <= float(v) <= 5.0 for v in lines)   # one line per test row
    assert os.path.isdir(f"{tmpdir_fresh}/report")
