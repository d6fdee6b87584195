"""The prefix-filter join: every similar pair of different classes, at the first token that the two share."""

import random

from pyspark.sql import functions as F

from reelstat.llm import linking
from reelstat.llm.common import written


def _sets():
    """Groups of sets of about 60 tokens with much in common, from not similar enough to equal but for a token."""
    rng = random.Random(5)
    sets = []
    for g in range(6):
        core = [g * 1000 + i for i in range(54 if g % 2 else 40)]
        for i in range(14):
            own = [100_000 + len(sets) * 100 + j for j in range(rng.choice((2, 6, 10, 18)))]
            sets.append(frozenset(rng.sample(core, len(core) - rng.choice((0, 1, 3))) + own))
    return sets


def _joined(spark, sets, labels, similarity=0.8):
    rows = spark.createDataFrame([(i, len(s), labels[i]) for i, s in enumerate(sets)], "id long, size int, label long")
    listed = spark.createDataFrame([(i, t) for i, s in enumerate(sets) for t in s], "id long, token long")
    pairs = linking._meetings(written(rows, "test-unresolved"), lambda ids: listed.join(ids, "id"), similarity)
    return [(r.a, r.b) for r in pairs.collect()]


def _similar(sets, labels, similarity=0.8):
    return {
        (i, j)
        for j, y in enumerate(sets)
        for i, x in enumerate(sets[:j])
        if labels[i] != labels[j] and len(x & y) >= similarity * len(x | y)
    }


def test_every_similar_pair_meets(spark, monkeypatch):
    sets = _sets()
    labels = [i if i % 3 else 0 for i in range(len(sets))]  # some are of one class already
    want = _similar(sets, labels)
    assert want
    for earlier in (64, 3, 0):  # however many earlier tokens go along
        monkeypatch.setattr(linking, "EARLIER", earlier)
        assert want <= set(_joined(spark, sets, labels))


def test_sets_alike_but_not_similar_do_not_meet(spark):
    """40 common tokens of 50 each are similarity 2/3: at the first shared token 40 are left, too few."""
    core = list(range(40))
    sets = [frozenset([*core, *range(1000 + 10 * i, 1010 + 10 * i)]) for i in range(30)]
    assert not _joined(spark, sets, list(range(30)))


def test_a_pair_meets_once(spark):
    """Sets meet at the first of their shared tokens, not at each."""
    x = frozenset(range(50))
    assert _joined(spark, [x | {1000}, x | {2000}], [0, 1]) == [(0, 1)]
